"""Secret scans (operator 9, DataFrame functions only).

Base kinds are patterns; the method adds tokens that look random. A
candidate is a run of 20 or more characters of the usual encodings. Its
encoding is inferred from the characters in it (digits, hex, letters of one
case or both, base32 and alphanumeric of either case, base62, base64 of
either kind), and three tests follow over the codes of that alphabet:

* chi-squared uniformity of the symbols,
* runs above and below the alphabet's median,
* lag-one serial correlation.

A token counts as random when none of the three departs from a uniform
source beyond its normal quantile (``z_limit``) *and* ordinary text is an
unlikely explanation: ordinary strings change between letters and digits,
or from lower to upper case, at no more than ``ordinary_rate`` of their
places, so the Chernoff bound on a larger count is a p-value under "ordinary
string". Strings without such changes are judged by their characters: with
O(x) the probability of the token under a first-order model of ordinary
strings (classes that mostly stay, letter pairs as in the corpus, digits
that often repeat or count up) and U(x) that of uniform symbols, O / U times
the number of alphabets is a p-value too (Markov's inequality). Twice the
smaller of both counts. The letter pairs are those of all whole texts, without
candidates, over a prior of letter frequencies: words are counted first,
map-side, then the pairs in the different words; 676 counts reach the driver.
The p-values go through a weighted Benjamini-Hochberg procedure
over *all* candidates of the corpus, with weights growing with length (mean
1), which bounds the expected share of ordinary strings among the tokens
reported. Counts per p-value bin are combined map-side; only the bin table
(at most ``bins`` rows) reaches the driver.

Positions are code points, end exclusive. They come from cutting the text
at the matches: a match starts where the gaps and matches before it end. Such
running sums go over blocks (:func:`running`), so their cost stays in
proportion to the number of matches, as does that of masking, which reads
each gap from a fixed-width encoding.

Defined results: a null text counts as empty and has no span; each row is
scanned by itself, so repeated rows give repeated results; very long texts
are scanned whole; an empty table gives an empty result; extra columns are
kept by :func:`redact` and ignored by :func:`scan`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, packed

# Fixed values of the contract: kinds in order, their patterns and checks.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the greedy run of 20+ characters in all
HEX = r"[0-9a-f]{24,}"

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
# A span as Spark type.
SPAN = "struct<kind:int,start:int,end:int,token:string>"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (  # pattern of the whole token, alphabet in code order
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[a-z]+$", LOWER),
    (r"^[A-Z]+$", UPPER),
    (r"^[A-Z2-7]+=*$", UPPER + "234567"),
    (r"^[a-z2-7]+=*$", LOWER + "234567"),
    (r"^[A-Z0-9]+$", DIGITS + UPPER),
    (r"^[a-z0-9]+$", DIGITS + LOWER),
    (r"^[A-Za-z]+$", UPPER + LOWER),
    (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    (r"^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    (r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
    (r"", UPPER + LOWER + DIGITS + "-_+/"),
)

# Ordinary strings: shares of the letters a-z in a thousand, and the chance
# that a lower-case letter, upper-case letter, digit, other character or the
# start is followed by a character of the first four classes.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
FOLLOWS = ((0.85, 0.05, 0.05, 0.05), (0.20, 0.70, 0.05, 0.05), (0.05, 0.05, 0.85, 0.05), (0.40, 0.20, 0.30, 0.10),
           (0.25, 0.25, 0.25, 0.25))


def running(values: Column, combine, zero: int = 0, block: int = 128) -> Column:
    """For each element of an array the combination (associative) of all
    before it, from ``zero``. An array grown by one element at a time costs
    the square of its length; here only blocks, and the list of blocks, grow
    that way."""
    none = F.array().cast("array<int>")

    def inside(part: Column) -> Column:
        begin = F.struct(F.lit(zero).alias("at"), none.alias("before"))
        return F.aggregate(part, begin, lambda a, x: F.struct(
            combine(a["at"], x).alias("at"), F.array_append(a["before"], a["at"]).alias("before")))

    def shift(a: Column, part: Column) -> Column:
        return F.struct(combine(a["at"], part["at"]).alias("at"), F.array_append(
            a["blocks"], F.transform(part["before"], lambda x: combine(a["at"], x))).alias("blocks"))

    blocks = F.transform(F.sequence(F.lit(0), F.size(values) - 1, F.lit(block)),
                         lambda i: inside(F.slice(values, i + 1, F.lit(block))))
    begin = F.struct(F.lit(zero).alias("at"), F.array().cast("array<array<int>>").alias("blocks"))
    return F.when(F.size(values) == 0, none).otherwise(F.aggregate(blocks, begin, shift, lambda a: F.flatten(a["blocks"])))


def find_spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Array of (kind, start, end, matched text) of the leftmost matches, of
    which those with a shorter ``value_group`` are dropped afterwards."""
    p = F.lit(pattern)
    matches = F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(value_group))

    def spans(cut: Column) -> Column:
        steps = F.transform(cut, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0)))
        placed = F.arrays_zip(cut.alias("cut"), running(steps, lambda a, x: a + x).alias("at"))
        hits = F.filter(placed, lambda x: x["cut"]["hit"].isNotNull() & (F.length(x["cut"]["value"]) >= least))
        return F.transform(hits, lambda x: let(x["at"] + F.length(x["cut"]["gap"]), lambda start: F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(x["cut"]["hit"])).alias("end"),
            x["cut"]["hit"].alias("token"))))

    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("hit"), values.alias("value"))
    return F.when(text.rlike(pattern), let(pieces, spans)).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> list[Column]:
    return [find_spans(text, ASSIGN, 0, 2, ASSIGN_VALUE), find_spans(text, ACCESS, 1), find_spans(text, HEX, 2)]


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, by start, then kind as listed."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(order, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def alphabet_of(token: Column) -> Column:
    out = F.lit(ALPHABETS[-1][1])
    for pattern, alphabet in reversed(ALPHABETS[:-1]):
        out = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(out)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sum_of_squared_counts(codes: Column) -> Column:
    """In the sorted codes, the i-th of a run of equal ones adds 2 i - 1."""
    def step(a: Column, x: Column) -> Column:
        run = F.when(x == a["last"], a["run"] + 1).otherwise(F.lit(1.0))
        return F.struct(x.alias("last"), run.alias("run"), (a["sum"] + 2 * run - 1).alias("sum"))
    zero = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.array_sort(codes), zero, step, lambda a: a["sum"])


def walk(codes: Column, middle: Column) -> Column:
    """(runs above and below the middle, sums for the serial correlation)."""
    def step(a: Column, x: Column) -> Column:
        change = a["last"].isNull() | ((a["last"] > middle) != (x > middle))
        cross = F.coalesce((a["last"] - middle) * (x - middle), F.lit(0.0))
        return F.struct(x.alias("last"), (a["runs"] + F.when(change, 1.0).otherwise(0.0)).alias("runs"),
                        (a["cross"] + cross).alias("cross"),
                        (a["square"] + (x - middle) * (x - middle)).alias("square"))
    zero = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("runs"),
                    F.lit(0.0).alias("cross"), F.lit(0.0).alias("square"))
    return F.aggregate(codes, zero, step)


def z_scores(codes: Column, k: Column) -> Column:
    """The three tests of a code sequence over an alphabet of ``k`` symbols,
    each as a normal score (chi-squared with its mean and variance)."""
    n, middle = F.size(codes).cast("double"), (k - 1) / 2
    chi = k / n * sum_of_squared_counts(codes) - n
    uniform = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    return let(walk(codes, middle), lambda w: F.struct(
        n.alias("n"), uniform.alias("uniform"),
        ((w["runs"] - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4)).alias("runs"),
        (w["cross"] / F.greatest(w["square"], F.lit(1e-9)) * F.sqrt(n)).alias("serial")))


def p_ordinary(body: Column, ordinary_rate: float) -> Column:
    """Chernoff bound for at least this many changes in an ordinary string."""
    letters = F.regexp_replace(body, "[^A-Za-z0-9]", "")
    border = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"
    changes = F.size(F.split(letters, border)) - 1
    places = F.greatest(F.length(letters) - 1, F.lit(1)).cast("double")

    def bound(x: Column) -> Column:
        rate, n = x["rate"], x["places"]
        kl = (rate * F.log(rate / ordinary_rate)
              + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - ordinary_rate))).otherwise(0.0))
        return F.when(rate <= ordinary_rate, 1.0).otherwise(F.exp(-n * kl))

    return let(F.struct((changes / places).alias("rate"), places.alias("places")), bound)


def pair_costs(counts: dict[str, int], prior: float = 500.0) -> str:
    """For each pair of letters a character whose code, less 33, is eight
    times -log P(second | first), rounded down."""
    share = [x / sum(LETTERS) for x in LETTERS]
    out = ""
    for a in LOWER:
        total = sum(counts.get(a + b, 0) for b in LOWER) + prior
        for b, x in zip(LOWER, share):
            out += chr(33 + min(int(-8 * math.log((counts.get(a + b, 0) + prior * x) / total)), 93))
    return out


def letter_pairs(docs: DataFrame, text: str = "text") -> str:
    """:func:`pair_costs` of all whole texts, without candidates. Letter runs
    are counted as words, combined map-side; pairs are made from the different
    words alone."""
    plain = F.regexp_replace(F.lower(F.col(text)), "[a-z0-9+/_-]{20,}", " ")
    words = docs.select(F.explode(F.split(plain, "[^a-z]+")).alias("w")).filter(F.length("w") > 1).groupBy("w").count()
    pairs = words.select("count", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2)))).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("count").alias("n"))
    return pair_costs({r["pair"]: r["n"] for r in counts.collect()})  # at most 676 rows


def log_ordinary(symbols: Column, costs: str) -> Column:
    """Logarithm of the probability of a string under the ordinary model."""
    follows = F.array(*[F.lit(math.log(x)) for row in FOLLOWS for x in row])

    def step(a: Column, c: Column) -> Column:
        i = F.position(c, F.lit(LOWER + UPPER + DIGITS)) - 1
        here = F.struct(i.alias("i"), F.when(i < 0, 3).when(i < 26, 0).when(i < 52, 1).otherwise(2).alias("kind"))

        def add(x: Column) -> Column:
            last, letter = a["last"], x["kind"] < 2
            pair = -(F.ascii(F.substring(F.lit(costs), 26 * (last["i"] % 26) + x["i"] % 26 + 1, F.lit(1))) - 33) / 8
            up = F.pmod(x["i"] - last["i"], F.lit(10))
            count = F.when(up <= 1, math.log(0.3)).otherwise(math.log(0.05))  # 5 % each, a quarter more the same, and the next
            value = (F.when(letter & (last["kind"] < 2), pair).when(letter, -math.log(26))
                     .when((x["kind"] == 2) & (last["kind"] == 2), count).when(x["kind"] == 2, -math.log(10))
                     .otherwise(-math.log(4)))
            return F.struct(x.alias("last"), (a["sum"] + value + F.get(follows, 4 * last["kind"] + x["kind"])).alias("sum"))

        return let(here, add)

    start = F.struct(F.struct(F.lit(0).alias("i"), F.lit(4).alias("kind")).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(symbols, start, step, lambda a: a["sum"])


def battery(token: Column, ordinary_rate: float = 0.15, costs: str | None = None) -> Column:
    """Struct (n, uniform, runs, serial, p) of a token; ``costs`` as from
    :func:`letter_pairs` (none: the prior)."""
    costs = costs or pair_costs({})

    def p_value(x: Column, n: Column) -> Column:
        symbols = F.filter(F.split(x["body"], ""), lambda c: c != "")
        ratio = log_ordinary(symbols, costs) + n * F.log(F.length(x["alphabet"]).cast("double"))
        by_symbols = F.exp(F.least(ratio + math.log(len(ALPHABETS)), F.lit(1.0)))
        return F.least(2 * F.least(p_ordinary(x["body"], ordinary_rate), by_symbols), F.lit(1.0))

    def tests(x: Column) -> Column:
        codes = F.transform(F.filter(F.split(x["body"], ""), lambda c: c != ""),
                            lambda c: (F.position(c, x["alphabet"]) - 1).cast("double"))
        z = let(codes, lambda u: z_scores(u, F.length(x["alphabet"]).cast("double")))
        return let(z, lambda s: F.struct(s["n"], s["uniform"], s["runs"], s["serial"],
                                         p_value(x, s["n"]).alias("p")))
    return let(F.struct(alphabet_of(token).alias("alphabet"), F.regexp_replace(token, "=+$", "").alias("body")), tests)


def candidates(scanned: DataFrame, costs: str | None = None) -> DataFrame:
    """One row per candidate token of the scan: its p-value and its weight
    before scaling (the square root of its length)."""
    rows = scanned.select(F.explode("tokens").alias("t")).select(
        battery(F.col("t.token"), costs=costs).alias("b"))
    return rows.select(F.col("b.p").alias("p"), F.sqrt(F.col("b.n")).alias("w"))


def discovery_limit(tested: DataFrame, rate: float = 0.01, step: float = 0.05, bins: int = 800) -> tuple[float, float]:
    """(mean weight, largest weighted p-value reported): Benjamini-Hochberg
    on a grid of p-values 10^(-step i). One aggregate by bin; the driver
    sees at most ``bins`` + 1 rows. Without a candidate: (1, 0)."""
    mean = tested.agg(F.avg("w"), F.count(F.lit(1))).first()
    if not mean[1]:
        return 1.0, 0.0
    p = F.col("p") / (F.col("w") / F.lit(mean[0]))
    bin_ = F.least(F.floor(F.greatest(-F.log10(F.greatest(p, F.lit(1e-300))), F.lit(0.0)) / step), F.lit(bins))
    counts = {int(r["b"]): r["n"] for r in
              tested.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    limit, seen = 0.0, 0
    for b in range(bins, -1, -1):  # p <= 10^(-step b) holds for the bins from b on
        seen += counts.get(b, 0)
        edge = 10.0 ** (-step * b)
        if seen and mean[1] * edge / seen <= rate:
            limit = edge
    return float(mean[0]), limit


def scan(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` plus ``base`` (spans of the base kinds, with their texts) and
    ``tokens`` (candidates that touch no base span), in place of columns so
    called. One pass, no shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = rows.withColumn("base", F.concat(*base_spans(t))).withColumn("tokens", find_spans(t, CANDIDATE, 3))
    clear = F.filter("tokens", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return d.withColumn("tokens", clear)


def random_tokens(tokens: Column, limits: tuple[float, float], z_limit: float = 3.5,
                  costs: str | None = None) -> Column:
    """The candidates that look random and pass the corpus-wide limit."""
    weight, limit = limits

    def looks_random(t: Column) -> Column:
        return let(battery(t["token"], costs=costs), lambda b: (b["p"] * F.lit(weight) <= F.lit(limit) * F.sqrt(b["n"]))
                   & (F.abs(b["runs"]) <= z_limit) & (F.abs(b["serial"]) <= z_limit) & (b["uniform"] <= z_limit))

    return F.filter(tokens, looks_random)


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans) per row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    scanned = materialize(scan(rows).drop("text"), "secret-spans")
    costs = letter_pairs(rows)
    limits = discovery_limit(candidates(scanned, costs))
    found = scanned.withColumn("tokens", random_tokens(F.col("tokens"), limits, costs=costs))

    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(F.col("doc_id").alias(key), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.concat("base", "tokens")).alias("spans"))


def mask_spans(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each span (overlapping ones joined) replaced by ``mark``.
    Gaps are cut from four bytes a character, so a cut costs its own length;
    a letter before each keeps a byte order mark at its start from being
    read as one."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    wide = F.encode(text, "UTF-32")

    def cut(raw: Column, start: Column, size: Column) -> Column:
        piece = F.concat(F.encode(F.lit("x"), "UTF-32"), F.substring(raw, 4 * start + 1, 4 * size))
        return F.substring(F.decode(piece, "UTF-32"), F.lit(2), size)

    def masked(x: Column) -> Column:
        before = running(F.transform(x["order"], lambda s: s["end"]), lambda a, e: F.greatest(a, e))
        placed = F.arrays_zip(x["order"].alias("span"), before.alias("at"), F.sequence(F.lit(1), F.size(x["order"])).alias("i"))
        parts = F.transform(placed, lambda p: F.when(
            (p["i"] == 1) | (p["span"]["start"] >= p["at"]),
            F.concat(cut(x["wide"], p["at"], p["span"]["start"] - p["at"]), F.lit(mark))).otherwise(F.lit("")))
        end = F.array_max(F.transform(x["order"], lambda s: s["end"]))
        rest = let(end, lambda e: cut(x["wide"], e, (F.octet_length(x["wide"]) / 4).cast("int") - e))
        return F.concat(F.array_join(parts, ""), rest)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.struct(order.alias("order"), wide.alias("wide")), masked))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by a mark; no row is dropped, and
    texts without a secret are untouched. The corpus-wide limit is learned
    in a first pass over narrow rows; the second pass keeps the texts."""
    narrow = scan(docs.select(F.col(text).alias("text"))).filter(F.size("tokens") > 0).select("tokens")
    costs = letter_pairs(docs, text)
    limits = discovery_limit(candidates(materialize(narrow, "secret-tokens"), costs))
    found = scan(packed(docs, F.col(text).alias("text")))
    masked = mask_spans(F.col("text"), F.concat(F.col("base"), random_tokens(F.col("tokens"), limits, costs=costs)))
    return found.select(*[masked.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
