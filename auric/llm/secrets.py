"""Secret scans: plain patterns plus character Markov models, in DataFrame functions.

Two first-order Markov models over the characters of a token, one of random strings
and one of ordinary identifiers, are estimated from labelled samples (add-one
smoothing). What base spans leave of the text is cut into tokens; a token of
``MIN_TOKEN`` characters or more is a secret if the log of its likelihood ratio, summed
over its character pairs, is at least ``MARGIN``. Where the whole token is none, its
segments between / _ = - of that length are judged the same way. Random strings are
made from hashes in the alphabets that keys come in; identifiers are words of a
bounded sample of ordinary texts (``ORDINARY_DOCS``, documented parameter; it serves
the fit only), as they are and joined the ways programs join them.

Everything is built-in functions in one narrow scan: patterns give the matches and
the stretches between them, whose lengths summed give places in code points; the fitted
table (a number for each pair of characters) is a constant array in the plan.
Running sums go over blocks of ``BLOCK`` matches, so that a text with very many
matches costs in proportion to them.

Defined results: null and empty texts have no spans; null and repeated ids and
repeated rows give a result each; method spans never overlap base spans or each
other; without ordinary texts the identifiers' model is uniform; other columns are
ignored by ``secret_spans`` and kept by ``redacted``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm.tables import table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"        # a whole run from AKIA on, 20 characters or more
HEX = r"[0-9a-f]{24,}"
MIN_TOKEN = 14         # 98 % of random strings of this length reach the margin
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
SEGMENT = rf"[A-Za-z0-9+]{{{MIN_TOKEN},}}"       # of a token, between / _ = -
SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MARGIN = 15.0
RANDOM_STRINGS = 4_000
ORDINARY_DOCS = 500
BLOCK = 256


# No match of any pattern holds a line break, or a space that no : or = stands beside, so
# such characters cut a text into chunks that can be scanned one by one.
CHUNK = 4096
CHUNKS = rf"(?s).{{{CHUNK}}}.*?(?:\n|(?<![:=\x20])\x20(?![\x20:=]))|.+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def _starts(gaps: Column, lens: Column, body) -> Column:
    """``body(i -> start)`` where match i follows gap i; sums by blocks."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(lens)), lens, lambda g, n: g + n)
    blocks = lambda d: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(d) - 1) / BLOCK).cast("int")),
        lambda k: _sum(F.slice(d, k * BLOCK + 1, F.lit(BLOCK))))

    def start(d, t, i):
        b = F.floor(i / BLOCK).cast("int")
        return (_sum(F.slice(t, F.lit(1), b)) + _sum(F.slice(d, b * BLOCK + 1, i - b * BLOCK))
                + F.element_at(gaps, i + 1))

    return let(steps, lambda d: let(blocks(d), lambda t: body(lambda i: start(d, t, i))))


def _span(start: Column, length: Column, kind: str) -> Column:
    return F.struct(start.cast("int").alias("s"), F.lit(KINDS.index(kind)).alias("k"),
                    (start + length).cast("int").alias("e"))


_NONE = "array<struct<s:int,k:int,e:int>>"


def found(text: Column, pattern: str, kind: str, least: int = 0, group: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` has at least
    ``least`` characters."""
    sizes = lambda a: F.transform(a, lambda s: F.length(s))
    parts = F.struct(
        sizes(F.split(text, pattern, -1)).alias("gaps"),
        sizes(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("lens"),
        sizes(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("own"))
    every = let(parts, lambda x: _starts(x["gaps"], x["lens"], lambda start: F.transform(
        F.filter(F.transform(x["lens"], lambda n, i: F.struct(
            _span(start(i), n, kind).alias("span"), F.element_at(x["own"], i + 1).alias("own"))),
            lambda y: y["own"] >= least),
        lambda y: y["span"])))
    return F.when(text.rlike(pattern), every).otherwise(F.array().cast(_NONE))


def base_spans(text: Column) -> Column:
    """Array of (s, k, e) by start, then kind."""
    return F.array_sort(F.concat(found(text, ASSIGN, "assign", 6, 2),
                                 found(text, ACCESS, "access"), found(text, HEX, "hex")))


def uncovered(text: Column, base: Column) -> Column:
    """``text`` with spaces for the characters that ``base`` covers; places stay."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def blank(acc, x):
        start, end = F.greatest(acc["at"], x["s"]), F.greatest(acc["at"], x["e"])
        return F.struct(
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, start - acc["at"]),
                     F.repeat(F.lit(" "), end - start)).alias("out"),
            end.alias("at"))

    return F.when(F.size(base) > 0, F.aggregate(base, state, blank, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.lit(1 << 30))))).otherwise(text)


def _judged(text: Column, pattern: str, ratios: Column) -> Column:
    """Spans of the matches that the random model explains better by ``MARGIN``."""
    sizes = lambda a: F.transform(a, lambda s: F.length(s))
    parts = F.struct(sizes(F.split(text, pattern, -1)).alias("gaps"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("tokens"))

    def tokens(x):
        return let(sizes(x["tokens"]), lambda lens: _starts(x["gaps"], lens, lambda start:
                   F.transform(x["tokens"], lambda w, i: F.struct(
                       _span(start(i), F.length(w), "random").alias("span"), w.alias("w")))))

    some = let(parts, lambda x: F.transform(
        F.filter(tokens(x), lambda y: log_ratio(y["w"], ratios) >= MARGIN),
        lambda y: y["span"]))
    return F.when(text.rlike(pattern), some).otherwise(F.array().cast(_NONE))


def random_spans(text: Column, base: Column, ratios: Column) -> Column:
    """Spans judged random in what ``base`` leaves uncovered: whole tokens, and the
    segments of the tokens that are not."""
    def both(rest):
        return let(_judged(rest, TOKEN, ratios), lambda whole: F.concat(whole, F.filter(
            _judged(rest, SEGMENT, ratios), lambda y: ~F.exists(
                whole, lambda x: (x["s"] <= y["s"]) & (y["e"] <= x["e"])))))

    return F.when(text.rlike(TOKEN), let(uncovered(text, base), both)
                  ).otherwise(F.array().cast(_NONE))


def log_ratio(token: Column, ratios: Column) -> Column:
    """Sum over the token's character pairs of log(p random / p identifier)."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(SIGNS), c))
    pairs = lambda x: F.zip_with(
        F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x)),
        lambda a, b: F.element_at(ratios, (a - 1) * len(SIGNS) + b))
    return let(codes, lambda x: F.aggregate(pairs(x), F.lit(0.0), lambda acc, y: acc + y))


def random_strings(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """Strings of 40 characters drawn by hash from the alphabets of keys."""
    hexes, upper, alnum = SIGNS[:6] + SIGNS[52:62], SIGNS[26:62], SIGNS[:62]
    drawn = lambda signs: F.concat_ws("", F.transform(
        F.sequence(F.lit(1), F.lit(40)), lambda i: F.substring(
            F.lit(signs), (F.pmod(F.xxhash64("id", i), F.lit(len(signs))) + 1).cast("int"),
            F.lit(1))))
    kind = F.col("id") % 4
    return spark.range(n).select(
        F.when(kind == 0, drawn(hexes)).when(kind == 1, drawn(upper))
        .when(kind == 2, drawn(alnum)).otherwise(drawn(SIGNS[:64])).alias("w"))


def identifiers(texts: DataFrame) -> DataFrame:
    """Words of ``texts`` (column t), alone and joined as identifiers."""
    plain = F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), rf"{ACCESS}|{HEX}", " ")
    words = F.regexp_extract_all(plain, F.lit("[A-Za-z]+"), F.lit(0))
    first, then = F.col("w"), F.coalesce("v", "w")
    pairs = (texts.select(words.alias("ws"))
             .select(F.posexplode(F.zip_with(
                 "ws", F.slice(F.col("ws"), 2, 1 << 30),
                 lambda a, b: F.struct(a.alias("w"), b.alias("v")))).alias("i", "p"))
             .select("i", "p.*"))
    kind = F.col("i") % 6
    return pairs.where("w is not null").select(
        F.when(kind == 0, first).when(kind == 1, F.lower(F.concat_ws("_", first, then)))
        .when(kind == 2, F.concat(F.lower(first), F.initcap(then)))
        .when(kind == 3, F.upper(F.concat_ws("_", first, then)))
        .when(kind == 4, F.concat(F.initcap(first), F.initcap(then), (F.col("i") % 100)
                                  .cast("string")))
        .otherwise(F.lower(F.concat(F.lit("/"), first, F.lit("-"), then))).alias("w"))


def _pair_counts(strings: DataFrame) -> dict[int, int]:
    at = lambda i: F.instr(F.lit(SIGNS), F.substring("w", i, F.lit(1)))
    pairs = F.transform(F.sequence(F.lit(2), F.length("w")),
                        lambda i: (at(i - 1) - 1) * len(SIGNS) + at(i) - 1)
    rows = (strings.where(F.length("w") >= 2).select(F.explode(pairs).alias("p"))
            .groupBy("p").count().collect())         # at most a row for each pair
    return {r["p"]: r["count"] for r in rows}


def fit(ordinary: DataFrame) -> list[float]:
    """Log ratio of each pair of characters; ``ordinary`` has a column t."""
    size = len(SIGNS)
    logs = []
    for counts in (_pair_counts(random_strings(ordinary.sparkSession)),
                   _pair_counts(identifiers(ordinary))):
        given = [sum(counts.get(a * size + b, 0) for b in range(size)) + size
                 for a in range(size)]
        logs.append([math.log((counts.get(a * size + b, 0) + 1) / given[a])
                     for a in range(size) for b in range(size)])
    return [x - y for x, y in zip(*logs)]


def ordinary_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", limit: int = ORDINARY_DOCS) -> DataFrame:
    """Texts of the ``limit`` documents labelled good with the smallest hash of their id."""
    ids = (labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
           .select(F.col("doc_id").alias("_known")).distinct()
           .orderBy(F.xxhash64("_known"), "_known").limit(limit))
    return (docs.join(ids, F.col(id_col) == F.col("_known"), "left_semi")
            .select(F.col(text_col).cast("string").alias("t")))


def constant(ratios: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")


def _names(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kind, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == KINDS.index(kind))).cast("bigint")


def _scanned(docs: DataFrame, text: Column, ratios: list[float], *keep: Column) -> DataFrame:
    """Columns ``keep``, the text's chunks (_chunks) and what is found in each (_found: base
    and random spans, places counted within the chunk). The work for a span follows the
    size of a chunk, not of the text."""
    def scan(chunk):
        return let(base_spans(chunk), lambda base: F.struct(
            base.alias("base"), random_spans(chunk, base, constant(ratios)).alias("random")))

    return (docs.select(*keep, F.regexp_extract_all(text, F.lit(CHUNKS), F.lit(0))
                        .alias("_chunks"))
            .select("*", F.transform("_chunks", scan).alias("_found")))


def _placed(name: str | None) -> Column:
    """All spans (or those of one name) with places in the whole text, by start, then kind."""
    def shifted(found, at):
        spans = F.concat(found["base"], found["random"]) if name is None else found[name]
        return F.transform(spans, lambda x: F.struct(
            (x["s"] + at).alias("s"), x["k"].alias("k"), (x["e"] + at).alias("e")))

    sizes = F.transform("_chunks", lambda c: F.length(c))
    every = let(sizes, lambda n: F.transform("_found", lambda found, i: shifted(
        found, _sum(F.slice(n, F.lit(1), i)))))
    return F.array_sort(F.flatten(every))


def secret_spans(docs: DataFrame, ratios: list[float], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_random, base_sha256, spans
    (kind:start:end in code points, end exclusive, by start, then kind)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base, every = F.col("_base"), F.col("_every")
    return (_scanned(docs, text, ratios, F.col(id_col))
            .select(id_col, _placed("base").alias("_base"), _placed(None).alias("_every"))
            .select(id_col, *[_count(every, k).alias(f"n_{k}") for k in KINDS],
                    F.sha2(_names(base).cast("binary"), 256).alias("base_sha256"),
                    _names(every).alias("spans")))


def redacted(docs: DataFrame, ratios: list[float], text_col: str = "text",
             mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all columns, with every stretch covered by spans replaced
    by ``mark``."""
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def clean(chunk, found):
        def cut(acc, x):
            apart = x["s"] >= acc["at"]
            return F.struct(
                F.when(apart, F.concat(acc["out"], F.substring(
                    chunk, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark)))
                .otherwise(acc["out"]).alias("out"),
                F.greatest(acc["at"], x["e"]).alias("at"))

        spans = F.array_sort(F.concat(found["base"], found["random"]))
        return F.when(F.size(spans) > 0, F.aggregate(spans, state, cut, lambda acc: F.concat(
            acc["out"], F.substring(chunk, acc["at"] + 1, F.lit(1 << 30))))).otherwise(chunk)

    some = F.exists("_found", lambda x: F.size(x["base"]) + F.size(x["random"]) > 0)
    new = F.when(some, F.array_join(F.zip_with("_chunks", "_found", clean), "")).otherwise(
        F.col("_doc")[text_col].cast("string"))
    return _scanned(docs, text, ratios, whole).select(
        *[new.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in names])


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return secret_spans(docs, fit(ordinary_texts(docs, labels)))


QUERIES = {"op6_secret_scan": op6_secret_scan}
ORACLE: dict[str, str] = {}
