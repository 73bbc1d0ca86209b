"""Text layouts: parse (S1-S5, F3) and format/write (K1, K3, K5).

All parsing is column expressions over a DataFrame of lines (the ``value``
column ``spark.read.text`` produces), so a scan splits across tasks like any
text file, and the same functions work on a streaming frame.

Tokenising follows the Java ``String.split`` the layouts were written for: the
separator is a literal (quoted), trailing empty tokens are dropped, a line of
separators only has no tokens and is skipped, and an empty token anywhere else
is a number-format error. Numbers use Java's double syntax (``1d``, ``NaN``,
``Infinity``, ``0x1p3``), which is what Spark's string->double cast accepts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LINE = "value"


def _quote(sep: str) -> str:
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def tokens(line: Column, sep: str = " ") -> Column:
    """Java-style split: drop trailing separators, then split on the literal."""
    q = _quote(sep)
    return F.split(F.regexp_replace(line, f"({q})+$", ""), q)


def has_tokens(line: Column, sep: str = " ") -> Column:
    """False for a non-empty line made of separators only (zero tokens)."""
    stripped = F.regexp_replace(line, f"({_quote(sep)})+$", "")
    return (stripped != F.lit("")) | (line == F.lit(""))


def parse_double(tok: Column, what: str = "number") -> Column:
    """String -> double, failing the job on a malformed token (like the
    reference's parse) whatever the session's ANSI setting is."""
    v = tok.try_cast("double")
    return F.when(v.isNull(), F.raise_error(F.concat(F.lit(f"bad {what}: '"), F.coalesce(tok, F.lit("")), F.lit("'")))).otherwise(v)


def parse_int(tok: Column, what: str = "id") -> Column:
    v = tok.try_cast("int")
    return F.when(v.isNull(), F.raise_error(F.concat(F.lit(f"bad {what}: '"), F.coalesce(tok, F.lit("")), F.lit("'")))).otherwise(v)


def to_doubles(toks: Column, d: int | None = None) -> Column:
    """Token array -> array<double>.

    With the width ``d`` known, the casts are unrolled over ``toks[i]`` (plain
    codegen'd expressions) after a width check; otherwise a ``transform``
    (interpreted higher-order function) handles any width."""
    if d is None:
        return F.transform(toks, lambda t: parse_double(t, "coordinate"))
    return _fixed_width(toks, d, lambda t: parse_double(t, "coordinate"))


def _fixed_width(toks: Column, d: int, conv) -> Column:
    arr = F.array(*[conv(toks.getItem(i)) for i in range(d)])
    bad = F.raise_error(F.concat(F.lit(f"expected {d} values, got "), F.size(toks).cast("string")))
    return F.when(F.size(toks) == F.lit(d), arr).otherwise(bad)


def parse_points(lines: DataFrame, sep: str = " ", line: str = LINE, dims: str = "dims",
                 d: int | None = None) -> DataFrame:
    """``d1 d2 ...`` -> dims array<double>; other columns are kept.
    ``d`` (optional) fixes the width and keeps the parse in generated code."""
    rest = [c for c in lines.columns if c != line]
    ok = lines.where(has_tokens(F.col(line), sep))
    return ok.select(*rest, to_doubles(tokens(F.col(line), sep), d).alias(dims))


def parse_centroids(lines: DataFrame, sep: str = " ", line: str = LINE, id_col: str = "cluster_id",
                    dims: str = "dims", d: int | None = None) -> DataFrame:
    """``id d1 d2 ...`` -> (int id, dims) (``d`` as in ``parse_points``)."""
    rest = [c for c in lines.columns if c != line]
    t = tokens(F.col(line), sep)
    ok = lines.where(has_tokens(F.col(line), sep)).select(*rest, t.alias("_t"))
    coords = F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0)))
    return ok.select(*rest, parse_int(F.col("_t")[0]).alias(id_col), to_doubles(coords, d).alias(dims))


def parse_keyed(lines: DataFrame, line: str = LINE, id_col: str = "id", dims: str = "dims",
                cluster_col: str = "cluster_id", d: int | None = None,
                rejected: Observation | None = None) -> DataFrame:
    """S3: ``id,d1 d2 ...`` (point, cluster -1) or ``id,d1 d2 ...,cluster``
    (centroid). A line with one field fails; four or more fields are dropped
    (see ``keyed_rejects`` for them) and counted: ``rejected.get["rejected"]`` has
    their number after the first action, from the same pass."""
    rest = [c for c in lines.columns if c != line]
    f = tokens(F.col(line), ",")
    x = lines.select(*rest, f.alias("_f"))
    x = x.withColumn("_n", F.when(F.size("_f") < 2, F.raise_error(
        F.concat(F.lit("missing coordinates in keyed line: '"), F.array_join("_f", ","), F.lit("'")))).otherwise(F.size("_f")))
    if rejected is not None:
        x = x.observe(rejected, F.count(F.when(F.col("_n") > 3, 1)).alias("rejected"))
    x = x.where(F.col("_n") <= 3)
    cluster = F.when(F.col("_n") == 3, parse_int(F.col("_f")[2], "cluster")).otherwise(F.lit(-1))
    return x.select(*rest, parse_int(F.col("_f")[0]).alias(id_col),
                    to_doubles(tokens(F.col("_f")[1], " "), d).alias(dims),
                    cluster.alias(cluster_col))


def keyed_rejects(lines: DataFrame, line: str = LINE) -> DataFrame:
    """Lines of the keyed layout with four or more fields (the ones dropped)."""
    return lines.where(F.size(tokens(F.col(line), ",")) >= 4)


def parse_int_points(lines: DataFrame, sep: str = " ", line: str = LINE, dims: str = "dims",
                     d: int | None = None) -> DataFrame:
    """``i1 i2 ...`` -> array<int> (``d`` as in ``parse_points``)."""
    rest = [c for c in lines.columns if c != line]
    t = tokens(F.col(line), sep)
    conv = (lambda s: parse_int(s, "integer"))
    arr = F.transform(t, conv) if d is None else _fixed_width(t, d, conv)
    return lines.select(*rest, arr.alias(dims))


# ---- formatting (Java's Double.toString is what Spark's cast prints) --------

def vector_text(dims: Column, sep: str = " ") -> Column:
    return F.array_join(F.transform(dims, lambda x: x.cast("string")), sep)


def format_labelled(df: DataFrame, label: str = "cluster_id", dims: str = "dims") -> DataFrame:
    """K1: ``cluster TAB d1 d2 ...``."""
    return df.select(F.concat_ws("\t", F.col(label).cast("string"), vector_text(F.col(dims))).alias(LINE))


def format_centroid_lines(df: DataFrame, id_col: str = "cluster_id", dims: str = "dims", sep: str = " ") -> DataFrame:
    """K5: ``id d1 d2 ...`` (what S2 reads back)."""
    return df.select(F.concat_ws(sep, F.col(id_col).cast("string"), vector_text(F.col(dims), sep)).alias(LINE))


def format_point_lines(df: DataFrame, dims: str = "dims", sep: str = " ") -> DataFrame:
    return df.select(vector_text(F.col(dims), sep).alias(LINE))


def format_keyed(df: DataFrame, id_col: str = "id", dims: str = "dims", cluster_col: str | None = "cluster_id") -> DataFrame:
    """K3: ``id,d1 d2 ...[,cluster]`` (what S3 reads back)."""
    parts = [F.col(id_col).cast("string"), vector_text(F.col(dims))]
    if cluster_col is not None:
        parts.append(F.col(cluster_col).cast("string"))
    return df.select(F.concat_ws(",", *parts).alias(LINE))


# ---- files ---------------------------------------------------------------

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_points(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return parse_points(read_lines(spark, path), sep)


def read_centroids(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return parse_centroids(read_lines(spark, path), sep)


def read_keyed(spark: SparkSession, path: str, rejected: Observation | None = None) -> DataFrame:
    return parse_keyed(read_lines(spark, path), rejected=rejected)


def write_keyed(df: DataFrame, path: str, id_col: str = "id", dims: str = "dims", cluster_col: str | None = "cluster_id") -> None:
    write_lines(format_keyed(df, id_col, dims, cluster_col), path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Overwrite ``path`` (any Hadoop path; a shared store on a cluster)."""
    lines.write.mode("overwrite").text(path)


def write_labelled(df: DataFrame, path: str, label: str = "cluster_id", dims: str = "dims") -> None:
    write_lines(format_labelled(df, label, dims), path)
