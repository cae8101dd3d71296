"""Query plans over the test tables: derived inputs (``inputs``) and the
registered queries with their SQL oracles (``catalog``)."""
