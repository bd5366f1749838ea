"""Line deduplication by distinct-site spread.

A line that stands on many sites is boilerplate. A text that is copied, whole and equal, over many sites counts for one
of them, so that copying alone makes no line common. A HyperLogLog sketch of the sites per line hash merges by aggregation
(partial sketches first, so a line on every page costs one row a task); lines whose estimate is near the threshold get
an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import discard, save, texts

MIN_SITES, LG_K, ERRORS = 10, 12, 5.0


def _key(c: Column) -> list[Column]:
    """128 bits of a line: two independent 64-bit hashes."""
    return [F.xxhash64(c).alias("h1"), F.xxhash64(F.lit("line"), c).alias("h2")]


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with more than blanks: row key (k1, k2), pos (from 0), site, h1, h2."""
    each = docs.select("k1", "k2", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    each = each.withColumn("line", F.trim(F.translate("line", "\t\r", "  "))).where("line != ''")
    return each.select("k1", "k2", "pos", "site", *_key(F.col("line")))


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2) of lines on at least ``min_sites`` sites, from (h1, h2, site)."""
    # Below the error band the estimate decides against, above it for; within it the sites are counted exactly.
    width = ERRORS * 1.04 / 2 ** (lg_k / 2)
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
    spread = save(spread.where(F.col("sites") >= int(min_sites * (1 - width))), "line-spread")
    above = F.col("sites") > min_sites * (1 + width)
    near = lines.join(spread.where(~above), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = near.groupBy("h1", "h2").count().where(F.col("count") >= min_sites)
    return spread.where(above).select("h1", "h2").unionByName(exact.select("h1", "h2"))


def _site(name: Column) -> Column:
    """A site as a number; an absent one counts as one site of its own."""
    return F.coalesce(F.xxhash64(F.lit("site"), name), F.lit(0))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by a key, with the site as a number."""
    keys = {"k1": F.coalesce("doc_id", F.lit(-1)), "k2": F.col("text_key")}
    return docs.withColumns(keys | {"name": F.col("site"), "site": _site(F.col("site"))})


def _one_site(docs: DataFrame) -> DataFrame:
    """(k2, one): for each text on more than one site the first of them by name, which stands for all."""
    sites = docs.groupBy("k2").agg(F.min("site").alias("low"), F.max("site").alias("high"), F.min("name").alias("name"))
    return sites.where("low <> high").select("k2", _site(F.col("name")).alias("one"))


def _common(docs: DataFrame, min_sites: int) -> DataFrame:
    """(k1, k2, n, gone): of each document with boilerplate lines how many, and for each line up to the last such one
    whether it is one. Lines are cut and hashed once and stored, without their texts."""
    lines = save(_lines(docs), "lines")
    # Stored, so that its size is known: where it is small the lines of a very common text are not gathered.
    one = save(_one_site(docs), "one-site")
    spread = lines.join(one, "k2", "left").select("h1", "h2", F.coalesce("one", "site").alias("site"))
    hit = lines.join(boilerplate(spread, min_sites), ["h1", "h2"], "left_semi")
    # Repeated rows share their key, so their positions come once.
    at = hit.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    at = at.withColumn("before", F.concat(F.array(F.lit(-1)), F.slice("at", 1, F.size("at") - 1)))
    flags = F.transform(F.arrays_zip("at", "before"), lambda x: F.concat(F.array_repeat(F.lit(False), x["at"] - x["before"] - 1), F.array(F.lit(True))))
    found = save(at.select("k1", "k2", F.size("at").cast("long").alias("n"), F.flatten(flags).alias("gone")), "line-hits")
    discard(lines, one)
    return found


def _without(text: Column, gone: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.coalesce(F.get(gone, i), F.lit(False))), "\n")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_boilerplate, n_removed, clean_text.

    A line is its text without blanks at both ends; lines of blanks only are never boilerplate. Lines on at least
    ``min_sites`` distinct sites are boilerplate and go in every document, also where nothing else is left. Equal texts
    count for one site, the first by name, however many they stand on.
    Null or empty text: one empty line, nothing removed, clean_text ''.
    Null site: counts as one more site. Null id: kept as null. Repeated rows: one result each. Empty input: empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    docs = _keyed(texts(docs, id_col, text_col, F.col(site_col).cast("string").alias("site")))
    out = docs.join(_common(docs, min_sites), ["k1", "k2"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.select(
        "doc_id",
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.col("n").alias("n_boilerplate"),
        F.col("n").alias("n_removed"),
        F.when(F.col("n") == 0, F.col("text")).otherwise(_without(F.col("text"), F.col("gone"))).alias("clean_text"),
    )


def rewrite(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    chars_col: str = "n_chars",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``docs``, all rows and columns, with boilerplate removed from the texts as ``line_dedup`` says.

    A text from which nothing is removed stays as it is, also null; ``chars_col``, if there, follows a changed text.
    Null id or site, repeated rows and empty input: as in ``line_dedup``.
    """
    own = _keyed(texts(docs, id_col, text_col, F.col(site_col).cast("string").alias("site")))
    hit = _common(own, min_sites).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("gone").alias("__gone"))
    text = F.coalesce(docs[text_col], F.lit(""))
    same = (F.coalesce(docs[id_col].cast("long"), F.lit(-1)) == hit["__k1"]) & (F.xxhash64(text) == hit["__k2"])
    joined = docs.join(hit, same, "left")
    changed, clean = F.col("__gone").isNotNull(), _without(text, F.col("__gone"))
    new = {text_col: F.when(changed, clean).otherwise(docs[text_col])}
    if chars_col in docs.columns:
        new[chars_col] = F.when(changed, F.length(clean).cast(docs.schema[chars_col].dataType)).otherwise(docs[chars_col])
    return joined.select(*[new.get(c, docs[c]).alias(c) for c in docs.columns])


#: The same rows in DuckDB SQL, with exact counts.
SQL = f"""
with d as (select doc_id, coalesce(text, '') as text, source, row_number() over () as r from documents),
l as (select r, source, pos - 1 as pos, s[pos] as line, trim(translate(s[pos], chr(9) || chr(13), '  ')) as key
      from (select r, source, string_split(text, chr(10)) as s, unnest(range(1, len(string_split(text, chr(10))) + 1)) as pos from d)),
o as (select text, min(source) as site from d group by text),
c as (select key from l join d using (r) join o using (text) where key <> '' group by key having count(distinct site) + max(case when site is null then 1
  else 0 end) >= {MIN_SITES}),
h as (select r, count(*) as n from l join c using (key) group by r),
k as (select l.r, string_agg(line, chr(10) order by pos) as clean from l left join c using (key) where c.key is null group by l.r)
select d.doc_id, cast(len(string_split(d.text, chr(10))) as bigint) as n_lines, cast(coalesce(h.n, 0) as bigint) as n_boilerplate,
       cast(coalesce(h.n, 0) as bigint) as n_removed, case when h.n is null then d.text else coalesce(k.clean, '') end as clean_text
from d left join h using (r) left join k using (r)
"""
