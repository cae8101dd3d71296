"""Token ids of whole texts under a ``tokenizers`` file, cut at safe
boundaries so that each distinct segment is encoded once per group of texts.

A boundary is a single space between two characters that are not white
space: the pre-tokenizers used here start a token at such a space and never
span it, so the ids of the text are the ids of its segments in order. Texts
whose spaces touch other white space are cut only at the safe ones. Special
strings inside a text hold no space, so they stay in one segment and are
handled as the library does by default. Segments are encoded many to one
text, whose tokens that start with a space start the segments. Where the
tokenizer parts letters from marks and from a line feed (tested on each mark),
a word with those behind it is encoded part by part. Words of letters need no
search for boundaries: where the tokenizer's own pre-tokenizer leaves them
whole (tested), the tokenizer's model gets them as it would spell them, from
Arrow arrays and without a cache, as most are rare and an object for each costs
more than encoding it again in the next group. Marks and other segments are kept
in bounded caches per worker.
"""

from __future__ import annotations

import re

from tessera.llm.common import TwoTierCache

# ASCII letters and those of Latin-1 are letters to every tokenizer's Unicode tables.
_LETTERS, _MARKS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+", "[.,:;!?$%&*#|]*"
LETTERS = re.compile(_LETTERS)
# A word of letters with marks behind it, and perhaps another one on the next line (for Arrow).
PARTED = f"(?P<core>{_LETTERS})(?P<marks>{_MARKS})(?:\n(?P<next>{_LETTERS})(?P<last>{_MARKS}))?"

SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


# White space other than the space and the line feed.
OTHER_SPACES = [*map(chr, [9, 11, 12, 13, *range(0x1c, 0x20), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b), 0x2028, 0x2029,
                           0x202f, 0x205f, 0x3000])]


def every_space_is_safe(text: str) -> bool:
    """Whether all spaces stand alone between other characters (texts with
    rarer white space are not looked at closer)."""
    return not (text[0] == " " or text[-1] == " " or "  " in text or "\n " in text or " \n" in text
                or any(map(text.__contains__, OTHER_SPACES)))


class HfSegments:
    """``id_bytes``: each text's ids as little-endian unsigned 32-bit."""

    def __init__(self, path: str, cache_size: int, longest: int = 64):
        import numpy as np
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache = TwoTierCache(cache_size)  # segments after a space, spelled without it
        self.firsts = TwoTierCache(cache_size // 16)  # other segments
        self.longest = longest
        # A pre-tokenizer that does not keep a leading space with its word
        # gets whole texts.
        space = self.tokenizer.encode(" x", add_special_tokens=False).tokens[:1]
        mark = space[0][0] if space and space[0] else "x"
        size = self.tokenizer.get_vocab_size()
        self.starts = np.array([(self.tokenizer.id_to_token(i) or "x")[0] == mark for i in range(size)])
        whole = self.tokenizer.encode("ab cd", add_special_tokens=False).ids
        parts = [self.tokenizer.encode(s, add_special_tokens=False).ids for s in ("ab", " cd")]
        self.safe = mark != "x" and whole == parts[0] + parts[1]

        def ids(s: str) -> list[int]:
            return self.tokenizer.encode(s, add_special_tokens=False).ids

        marks = ["", *".,:;!?$%&*#|", ".,", "!!", "$$$"]
        self.parts_marks = all(ids(f" a\u00e9b{m}") == ids(" a\u00e9b") + ids(m) for m in marks)
        self.parts_lines = self.parts_marks and all(
            ids(f" a\u00e9b{m}\n{w}{m}") == ids(" a\u00e9b") + ids(m) + ids("\n") + ids(w) + ids(m)
            for m in marks for w in ("Cd", "cd", "\u00c9"))
        self.line = np.asarray(ids("\n"), dtype="<u4").tobytes()
        self.mark = mark
        self.letters = self._letters_tokenizer() if self.safe else None

    def _letters_tokenizer(self):
        """The model alone, for words of letters spelled by the pre-tokenizer;
        None where that one changes or divides them, or a special string
        consists of letters."""
        from tokenizers import Tokenizer, pre_tokenizers
        t, pre = self.tokenizer, self.tokenizer.pre_tokenizer
        if t.normalizer is not None or pre is None or any(
                not re.search(r"[^\w\s]", x.content) for x in t.get_added_tokens_decoder().values()):
            return None
        high = [chr(c) for c in range(0xc0, 0x100) if LETTERS.fullmatch(chr(c))]
        self.spelling = {ord(c): "".join(x for x, _ in pre.pre_tokenize_str(c)) for c in high}
        probes = ["x", "Xy", "XYz", "xYZ", "aBcD", "A", "thes", "ll", *high, "".join(high), "q".join(high)]
        for head in ("", " "):
            for w in probes:
                if [x for x, _ in pre.pre_tokenize_str(head + w)] != [(head and self.mark) + w.translate(self.spelling)]:
                    return None
        model = Tokenizer(t.model)
        model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        return model

    def _encode(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        return [np.asarray(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words):
        """Ids of " " + word, an Arrow array like that of the different words
        (without white space at their ends). Words of letters, with marks and
        perhaps a second line, are told from the others, put together and
        encoded without a Python object for each."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if self.letters is None or not self.parts_marks:
            return self._cached(self.cache, words, self._encode_plain)
        found = pc.extract_regex(words, pattern=f"^{PARTED}$")
        plain = found.is_valid()
        if not self.parts_lines:
            plain = pc.and_(plain, pc.fill_null(pc.equal(pc.struct_field(found, "next"), ""), False))
        core, mark, line, last = (c.dictionary_encode() for c in found.filter(plain).flatten())

        def ids(coded, encode):
            return encode(coded.dictionary).take(coded.indices)

        breaks = ids(line, lambda x: pc.if_else(pc.equal(x, ""), pa.scalar(b"", pa.large_binary()),
                                                pa.scalar(self.line, pa.large_binary())))
        starts = ids(line, self._line_start_ids)
        marks = [ids(x, lambda m: self._cached(self.firsts, m, self._encode)) for x in (mark, last)]
        parts = pc.binary_join_element_wise(ids(core, self._letter_ids), marks[0], breaks, starts, marks[1],
                                            pa.scalar(b"", pa.large_binary()))
        others = words.filter(pc.invert(plain))
        if not len(others):
            return parts
        return _merged(plain, parts, self._cached(self.cache, others, self._encode_plain))

    def _letter_ids(self, words):
        """Ids of " " + word for words of letters."""
        import numpy as np
        import pyarrow as pa

        def some(words):
            all_ids = self._spelled(words, self.mark, "")
            return _binary(all_ids, np.r_[np.flatnonzero(self.starts[all_ids]), len(all_ids)])

        return self._by_spelling(words, some) if len(words) else pa.array([], pa.large_binary())

    def _line_start_ids(self, words):
        """Ids of words of letters without a space before them (of an empty
        one: none); the space's own id, which no such word holds, goes behind
        each."""
        import numpy as np

        if not len(words) or len(self._spelled(words.slice(0, 0), self.mark, "")) != 1:
            return self._cached(self.firsts, words, self._encode)

        def some(words):
            all_ids = self._spelled(words, "", f"\n{self.mark}")
            ends = np.flatnonzero(self.starts[all_ids])
            return _binary(np.delete(all_ids, ends), np.r_[0, ends - np.arange(len(ends))])

        return self._by_spelling(words, some)

    def _by_spelling(self, words, encode, chunk: int = 8192):
        """``encode`` on parts of the words, those of ASCII letters apart."""
        import pyarrow as pa
        import pyarrow.compute as pc
        simple = pc.string_is_ascii(words)
        found = [pa.concat_arrays([encode(group.slice(i, chunk)) for i in range(0, len(group), chunk)]
                                  or [pa.array([], pa.large_binary())])
                 for group in (words.filter(simple), words.filter(pc.invert(simple)))]
        return _merged(simple, *found)

    def _spelled(self, words, before: str, behind: str):
        """Ids of the words as the pre-tokenizer would spell them, one behind
        the other (no words: of one empty word)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        text, between = pc.binary_join(whole, pa.scalar("\n", words.type))[0].as_py(), f"{behind}\n{before}"
        if text.isascii():
            text = text.replace("\n", between)
        else:  # str.translate takes ten times as long
            spelled = [between if c == "\n" else self.spelling.get(ord(c), c) for c in map(chr, range(256))]
            sizes = np.array([len(x) for x in spelled])
            letters = np.frombuffer(text.encode("latin-1"), np.uint8)
            n = sizes[letters]
            at = np.repeat((np.cumsum(sizes) - sizes)[letters] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            text = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4")[at].tobytes().decode("utf-32-le")
        text = before + text + behind
        return np.asarray(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _encode_plain(self, words: list[str], chunk: int = 8192) -> list[bytes]:
        import numpy as np
        out: list[bytes] = []
        for i in range(0, len(words), chunk):
            group = words[i:i + chunk]
            ids = np.asarray(self.tokenizer.encode_batch_fast(
                [" " + " ".join(group)], add_special_tokens=False)[0].ids, dtype="<u4")
            at = np.flatnonzero(self.starts[ids])
            if len(at) != len(group):  # a segment with a space inside
                return out + self._encode([" " + w for w in words[i:]])
            cuts = [*(4 * at).tolist(), 4 * len(ids)]
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _filled(self, cache: TwoTierCache, keys: list[str], encode) -> list[bytes]:
        """The value of each key; those in neither generation of the cache
        are encoded together."""
        values = list(map(cache.young.get, keys))
        gaps = [i for i, v in enumerate(values) if v is None]
        if gaps:
            unknown = list(dict.fromkeys([keys[i] for i in gaps]))
            fresh = dict(zip(unknown, map(cache.old.get, unknown)))
            todo = [k for k, v in fresh.items() if v is None]
            fresh.update(zip(todo, encode(todo)))
            cache.extend([(k, v) for k, v in fresh.items() if len(k) <= self.longest])
            for i in gaps:
                values[i] = fresh[keys[i]]
        return values

    def _cached(self, cache: TwoTierCache, words, encode):
        """:meth:`_filled` for Arrow arrays."""
        import pyarrow as pa
        return pa.array(self._filled(cache, words.to_pylist(), encode), pa.large_binary())

    def id_bytes(self, texts: list[str | None], most: int = 1 << 22) -> list[bytes]:
        """Each text's ids; texts go in groups of about ``most`` characters,
        longer ones in parts cut at safe spaces."""
        if not self.safe:
            return self._encode([t or "" for t in texts])
        out: list[list[bytes]] = [[] for _ in texts]
        parts: list[str] = []  # whose spaces are all safe
        of: list[tuple[int, bool]] = []  # text, and whether the part follows a space
        odd: list[int] = []  # texts with other spaces
        size = 0

        def flush():
            cut = [SAFE_SPACE.split(texts[k]) for k in odd]
            after = [x for _, x in of] + [False] * len(odd)
            for k, ids in zip([*[k for k, _ in of], *odd], self._parts_ids(parts, cut, after)):
                out[k].append(ids)

        for k, t in enumerate(texts):
            if not t:
                out[k].append(b"")
                continue
            at = 0
            while at < len(t):
                if not at and not every_space_is_safe(t):
                    odd.append(k)
                    size += len(t)
                    at = len(t)
                else:
                    cut = t.find(" ", at + most) if len(t) - at > most else -1
                    parts.append(t[at:cut] if cut >= 0 else t[at:] if at else t)
                    of.append((k, at > 0))
                    size += len(parts[-1])
                    at = cut + 1 if cut >= 0 else len(t)
                if size >= most:
                    flush()
                    parts, of, odd, size = [], [], [], 0
        flush()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _parts_ids(self, parts: list[str], cut: list[list[str]], after_space: list[bool]) -> list[bytes]:
        """Ids of parts whose spaces are all safe, then of texts already cut
        into segments. Words are told apart by Arrow's dictionary encoding, and
        ids are gathered by number."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not parts and not cut:
            return []
        lists = [pc.split_pattern(pa.array(parts, pa.large_string()), " "), pa.array(cut, pa.list_(pa.large_string()))]
        ends = np.cumsum(np.concatenate([pc.list_value_length(x).to_numpy().astype(np.int64) for x in lists]))
        coded = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        heads = np.r_[0, ends[:-1]][~np.array(after_space)]  # segments without a space before them
        first, number = np.unique(at[heads], return_inverse=True)
        at[heads] = len(coded.dictionary) + number
        values = pa.concat_arrays([  # a word found only as a head is encoded for nothing
            self._word_ids(coded.dictionary), self._cached(self.firsts, coded.dictionary.take(pa.array(first)), self._encode)])
        _, past, ids = values.take(pa.array(at)).buffers()
        cuts = np.frombuffer(past, np.int64)[np.r_[0, ends]].tolist()
        ids = memoryview(ids) if ids else b""
        return [bytes(ids[a:b]) for a, b in zip(cuts, cuts[1:])]


def _binary(ids, cuts):
    """Ids between cuts (the first at 0, the last at the end) as an Arrow array of bytes."""
    import numpy as np
    import pyarrow as pa
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [
        None, pa.py_buffer(4 * cuts.astype(np.int64)), pa.py_buffer(ids)])


def _merged(flags, yes, no):
    """Values of ``yes`` where the flag is set, else of ``no``, each in order."""
    import numpy as np
    import pyarrow as pa
    flags = np.asarray(flags.to_numpy(zero_copy_only=False), bool)
    at = np.where(flags, np.cumsum(flags) - 1, len(yes) + np.cumsum(~flags) - 1)
    return pa.concat_arrays([yes, no]).take(pa.array(at, pa.int64()))
