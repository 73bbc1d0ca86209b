"""Secret scan: patterns, and character Markov models of random strings and of ordinary identifiers, compared by log-likelihood ratio.

The patterns find assignments, access keys and long hexadecimal runs. Every other run of 16 or more of the characters that keys are made
of is a candidate: its two probabilities, as a random string and as an ordinary identifier, are products over its character pairs, and
it is a secret where the logarithm of their ratio is high enough. Both models are trained from labelled samples. By default the sample is taken from
documents: what the patterns find is labelled random, other runs ordinary; strings made from digests add
alphabets that the patterns don't know, neighbouring words joined as programs do add identifiers.

All of it is made of built-in functions: a document is judged within its own row, without shuffle, join or Python. The models are one constant array
with an entry for each pair of characters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns' forms and least lengths are fixed values.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12
KINDS = ("assign", "access", "hex", "random")
#: Characters of candidates, in the order in which the models count them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Prior odds of an ordinary run against a random string; the ratio must outweigh them.
ODDS = 1000.0
#: Least mean logarithm of the ratio for a pair, so that a long run isn't taken for a slight leaning.
LEAST_MEAN = 0.25
#: Documents (as an expectation over distinct ones) of the labelled sample, runs taken of each, strings made of each alphabet.
SAMPLE_DOCS, SAMPLE_RUNS, SAMPLE_MADE = 20_000, 200, 2_500
#: Added to every pair's count.
SMOOTH = 0.5
#: Pairs summed at a time, and matches whose places are summed at a time.
CHUNK, BLOCK = 1024, 256


def _running(widths: Column) -> Column:
    """Running sums of an array, in blocks, so that the work is in proportion to its length."""
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    zero = F.array(F.lit(0).cast("long"))
    n = F.ceil(F.size(widths) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.aggregate(F.slice(widths, b * BLOCK + 1, F.lit(BLOCK)), zero, grow))
    before = lambda made: F.aggregate(F.transform(made, lambda b: F.element_at(b, -1)), zero, grow)
    summed = F.zip_with(blocks, before(blocks), lambda b, o: F.transform(F.slice(b, 2, BLOCK), lambda x: x + o))
    return F.when(F.size(widths) > 0, F.flatten(F.filter(summed, lambda b: b.isNotNull()))).otherwise(F.array().cast("array<bigint>"))


def _matches(df: DataFrame, text: str, pattern: str, name: str, group: int | None = None) -> DataFrame:
    """Adds ``name``: array of (start, end, value) of the pattern's matches in a text column, by code points; value is a group's or the match's text.

    The parts between the matches and the matches give the places. Columns follow each other, so that no expression is evaluated twice."""
    has = F.col(text).rlike(pattern)
    p = F.lit(pattern)
    df = df.withColumn("_found", F.when(has, F.regexp_extract_all(text, p, F.lit(0))))
    df = df.withColumn("_value", F.when(F.col("_found").isNotNull(), F.regexp_extract_all(text, p, F.lit(group))) if group else F.col("_found"))
    df = df.withColumn("_between", F.when(F.col("_found").isNotNull(), F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))))
    df = df.withColumn("_widths", F.transform(F.arrays_zip("_between", "_found"), lambda x: x["_between"] + F.coalesce(F.length(x["_found"]), F.lit(0))))
    df = df.withColumn("_ends", F.slice(_running(F.col("_widths")), F.lit(1), F.size("_found")))
    placed = F.transform(F.arrays_zip("_found", "_ends", "_value"), lambda x: F.struct((x["_ends"] - F.length(x["_found"])).alias("start"), x["_ends"].alias("end"), x["_value"].alias("value")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return df.withColumn(name, F.coalesce(placed, empty)).drop("_found", "_value", "_between", "_widths", "_ends")


def _blanked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """The text with every match (whose group has so many characters) replaced by as many line breaks."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("part"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    fill = lambda x: F.coalesce(F.when(F.length(x["value"]) >= least, F.rpad(F.lit(""), F.length(x["found"]), F.lit("\n"))), x["found"], F.lit(""))
    return F.when(text.rlike(pattern), F.array_join(F.transform(parts, lambda x: F.concat(x["part"], fill(x))), "")).otherwise(text)


def _base(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``assign``, ``access``, ``hex`` (arrays of matches that count) and ``rest``, the text without them."""
    df = _matches(docs, text, ASSIGN, "assign", 2)
    df = df.withColumn("assign", F.filter("assign", lambda m: F.length(m["value"]) >= ASSIGN_VALUE))
    df = _matches(_matches(df, text, ACCESS, "access"), text, HEX, "hex")
    for at, step in enumerate((lambda c: _blanked(c, ASSIGN, 2, ASSIGN_VALUE), lambda c: _blanked(c, ACCESS), lambda c: _blanked(c, HEX))):
        df = df.withColumn("rest", step(F.col("rest" if at else text)))
    return df


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(value, random) labelled by the patterns, from about ``n_docs`` documents chosen by a hash; equal documents and equal values count once."""
    total = docs.count()
    name = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    chosen = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), name.alias("name"))
    if total > n_docs:
        chosen = chosen.where(F.pmod("name", F.lit(1 << 30)) < int((1 << 30) * n_docs / total))
    df = _base(chosen, "text")
    runs = F.regexp_extract_all("rest", F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))
    hits = F.concat(F.transform("assign", lambda m: m["value"]), F.transform("access", lambda m: m["value"]), F.transform("hex", lambda m: m["value"]))
    df = df.select("name", F.slice(hits, 1, SAMPLE_RUNS).alias("hits"), F.slice(runs, 1, SAMPLE_RUNS).alias("runs")).groupBy("name").agg(F.first("hits").alias("hits"), F.first("runs").alias("runs"))
    #: neighbouring words as identifiers: under_scored, camelCase, with-hyphens, a/path
    pairs = F.zip_with(F.slice("runs", 1, SAMPLE_RUNS - 1), F.slice("runs", 2, SAMPLE_RUNS), lambda a, b: F.array(F.concat_ws("_", a, b), F.concat(a, F.initcap(b)), F.concat_ws("-", a, b), F.concat_ws("/", a, b)))
    ordinary = F.concat("runs", F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
    labelled = df.select(F.explode("hits").alias("value"), F.lit(True).alias("random")).unionByName(df.select(F.explode(ordinary).alias("value"), F.lit(False).alias("random")))
    digest = F.base64(F.unhex(F.sha2(F.concat(F.lit("made:"), F.col("id").cast("string")).cast("binary"), 256)))
    letters = F.regexp_replace(digest, "[+/=]", "")
    forms = F.array(digest, letters, F.translate(digest, "+/", "-_"), F.upper(letters), F.sha2(F.col("id").cast("string").cast("binary"), 224))
    made = docs.sparkSession.range(SAMPLE_MADE).select(F.explode(forms).alias("value"), F.lit(True).alias("random"))
    return labelled.unionByName(made).distinct()


class Models:
    """Logarithms of (probability in a random string / in an identifier) of each character, given the one before."""

    def __init__(self, ratios: list[float], threshold: float | None = None, least_mean: float = LEAST_MEAN):
        self.ratios, self.least_mean = ratios, least_mean
        self.threshold = math.log(ODDS) if threshold is None else threshold

    @classmethod
    def train(cls, labelled: DataFrame, **how) -> Models:
        """From (value, random); characters outside the alphabet end a run, null values and labels don't count. At most one count for each
        pair of characters and label reaches the driver."""
        runs = labelled.where("value is not null and random is not null").select("random", F.explode(F.regexp_extract_all("value", F.lit(r"[A-Za-z0-9+/_=-]{2,}"), F.lit(0))).alias("run"))
        chunks = runs.select("random", F.explode(F.regexp_extract_all("run", F.lit(rf"(?=(.{{1,{CHUNK + 1}}})).{{1,{CHUNK}}}"), F.lit(1))).alias("run")).where("length(run) > 1")
        pairs = chunks.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("run") - 1), lambda i: F.substring(F.col("run"), i, F.lit(2)))).alias("pair"))
        k = len(ALPHABET)
        counts = {True: [SMOOTH] * (k * k), False: [SMOOTH] * (k * k)}
        for r in pairs.groupBy("random", "pair").count().collect():
            counts[r["random"]][ALPHABET.index(r["pair"][0]) * k + ALPHABET.index(r["pair"][1])] += r["count"]
        rows = {label: [sum(c[a * k:(a + 1) * k]) for a in range(k)] for label, c in counts.items()}
        return cls([math.log(counts[True][i] / rows[True][i // k]) - math.log(counts[False][i] / rows[False][i // k]) for i in range(k * k)], **how)

    def ratio(self, run: Column) -> Column:
        """The logarithm of a run's ratio; a run of one character has 0."""
        k = len(ALPHABET)
        table = F.split(F.lit(",".join(repr(x) for x in self.ratios)), ",").cast("array<double>")  # folded to a constant by the optimizer
        at = lambda s, i: F.instr(F.lit(ALPHABET), F.substring(s, i, F.lit(1)))
        pair = lambda s: lambda i: F.element_at(table, (at(s, i) - 1) * k + at(s, i + 1))
        part = lambda s: F.when(F.length(s) > 1, F.aggregate(F.transform(F.sequence(F.lit(1), F.length(s) - 1), pair(s)), F.lit(0.0), lambda acc, x: acc + x)).otherwise(0.0)
        chunks = F.regexp_extract_all(run, F.lit(rf"(?=(.{{1,{CHUNK + 1}}})).{{1,{CHUNK}}}"), F.lit(1))
        return F.aggregate(F.transform(chunks, part), F.lit(0.0), lambda acc, x: acc + x)

    def is_random(self, run: Column) -> Column:
        ratio = self.ratio(run)
        return (ratio >= self.threshold) & (ratio >= self.least_mean * (F.length(run) - 1))


def scan(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    spans: all spans as kind:start:end (code points, end exclusive), by start and then kind in the order of KINDS, joined by commas;
    base_sha256: SHA-256 of the same string of the first three kinds. Spans found by the models have kind ``random``; they are sought in what the patterns leave. Null texts
    count as empty: no spans, an empty string. Ids may be null or repeated, other columns are not read."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = _matches(_base(df, "text"), "rest", CANDIDATE, "random")
    df = df.withColumn("random", F.filter("random", lambda m: models.is_random(m["value"])))
    listed = lambda i: F.transform(KINDS[i], lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end")))
    said = lambda kinds: F.array_join(F.transform(F.sort_array(F.concat(*map(listed, kinds))), lambda m: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), m["kind"] + 1), m["start"].cast("string"), m["end"].cast("string"))), ",")
    return df.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(said(range(3)).cast("binary"), 256).alias("base_sha256"),
        said(range(4)).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """``scan`` with models trained from ``labelled`` (value, random), by default from ``samples`` of the documents."""
    return scan(docs, Models.train(samples(docs, id_col, text_col) if labelled is None else labelled), id_col, text_col)
