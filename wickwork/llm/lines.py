"""Line dedup across sites: lines that stand on many distinct sites are boilerplate.

A line is what stands between line feeds; its key is the line without blanks at its ends.
Lines without other characters are never boilerplate. A HyperLogLog sketch of sites per
line key, merged by aggregation, estimates on how many sites the line stands. Estimates
near the threshold (a factor of `margin` around it, many standard errors of the sketch)
are replaced by exact distinct counts, so that the outcome is exact. Lines on `min_sites`
or more distinct sites are removed from every document.

A null site is no site. A null text has no lines and stays null; a text may become empty.
Repeated rows change nothing, as sites are counted once. Rows with the same id are cleaned
each on its own. Columns beyond those named are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm.common import staged

MIN_SITES = 10
MARGIN = 2.0
RSD = 0.1  # 128 registers
_BLANKS = " \t\r\x0b\x0c"


def _keyed_lines(docs: DataFrame, id_: str, text: str, site: str) -> DataFrame:
    """(id, v, pos, site, h, g): a 96-bit key for each line that is not blank; v tells rows of one id apart."""
    line = F.btrim("line", F.lit(_BLANKS))
    return (
        docs.select(
            F.col(id_).alias("id"), F.xxhash64(text).alias("v"), F.col(site).alias("site"),
            F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"),
        )
        .where(F.length(line) > 0)
        .select("id", "v", "pos", "site", F.xxhash64(line).alias("h"), F.hash(line).alias("g"))
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """(h, g) of the lines on at least `min_sites` distinct sites."""
    spread = staged(
        lines.groupBy("h", "g").agg(F.approx_count_distinct("site", RSD).alias("sites")).where(F.col("sites") >= min_sites / margin),
        "spread",
    )
    far = spread.where(F.col("sites") > min_sites * margin).select("h", "g")
    near = spread.where(F.col("sites") <= min_sites * margin).select("h", "g")
    # Distinct (line, site) pairs are merged in the tasks before the shuffle.
    exact = lines.join(near, ["h", "g"], "left_semi").groupBy("h", "g").agg(F.countDistinct("site").alias("sites"))
    return far.union(exact.where(F.col("sites") >= min_sites).select("h", "g"))


def _without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, places in parts:
        out = []
        for text, at in zip(texts, places):
            if text is not None and at is not None:
                gone = set(at)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            out.append(text)
        yield pd.Series(out, dtype=object)


def dedupe_lines(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
    counts: bool = False, seen: DataFrame | None = None,
) -> DataFrame:
    """`docs` with boilerplate lines removed from `text`; `counts` adds n_lines, n_removed (or replaces columns of these names).

    `seen`: the rows whose sites count, if not all of `docs`.
    """
    lines = staged(_keyed_lines(docs, id_, text, site), "lines")
    counted = lines if seen is None else staged(_keyed_lines(seen, id_, text, site), "seen-lines")
    hits = lines.join(boilerplate(counted, min_sites), ["h", "g"], "left_semi")
    at = hits.groupBy(F.col("id").alias("_id"), F.col("v").alias("_v")).agg(F.collect_set("pos").alias("_at"))
    joined = docs.join(at, docs[id_].eqNullSafe(at["_id"]) & (F.xxhash64(docs[text]) == at["_v"]), "left")
    without = F.pandas_udf(_without, "string")
    # By frame, as the documents may have columns of any name.
    own, gone = docs[text], at["_at"]
    kept = F.when(gone.isNotNull(), without(own, gone)).otherwise(own)
    added = {}
    if counts:
        n = F.when(own.isNull(), 0).otherwise(F.size(F.split(own, "\n", -1)))
        added = {"n_lines": n.cast("long"), "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long")}
    columns = [kept.alias(c) if c == text else docs[c] for c in docs.columns if c not in added]
    return joined.select(*columns, *[c.alias(name) for name, c in added.items()])
