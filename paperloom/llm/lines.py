"""Removal of lines that many sites share.

Per line hash a HyperLogLog sketch of sites is merged by aggregation, on the map side first, so
a line of a third of all rows is one small sketch per task. Only lines whose estimate is near
the threshold are counted exactly. Texts stay in place: hashes of their lines are looked up among
the wide ones, which are sent to all tasks while they are few, measured.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.staging import BROADCAST_BYTES, Staged, stage
from paperloom.llm.common import column, ship, unused
from paperloom.llm.minhash import near_duplicates

SALTS = 32


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _is_blank(line: Column) -> Column:
    return F.trim(line) == ""


def _pieces(text: str) -> Column:
    return F.split(column(text), "\n", -1)


def widespread_lines(lines: DataFrame, min_sites: int, lg_k: int = 12) -> DataFrame:
    """Hashes of lines found on at least `min_sites` distinct sites.

    `lines` has columns line (hash) and site. A null site counts for nothing. Estimates within
    three standard errors of the threshold, and at least one site, are replaced by exact counts.
    """
    sketches = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites")
    )
    margin = max(1, math.ceil(3 * 0.84 / math.sqrt(2**lg_k) * min_sites))
    found = stage(sketches.filter(F.col("sites") >= min_sites - margin), "line-spread").frame
    sure = found.filter(F.col("sites") > min_sites + margin).select("line")
    near = stage(found.filter(F.col("sites") <= min_sites + margin).select("line"), "near-lines")
    few = F.broadcast(near.frame) if near.fits(BROADCAST_BYTES) else near.frame
    exact = (
        lines.join(few, "line", "left_semi")
        .groupBy("line")
        .agg(F.count_distinct("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("line")
    )
    return sure.unionByName(exact)


def _copies(candidates: DataFrame, percent: int) -> DataFrame:
    """Site at which the near-duplicate class of a text counts, by key; candidates: key, site, text.

    Only classes of several sites are listed. The choice differs from class to class, by a digest
    of the site and the class, which is known by its smallest digest of a text.
    """
    found = near_duplicates(candidates, percent, "key", "text")
    classes = found.select(
        F.col("doc_id").alias("key"), F.coalesce("component_id", "doc_id").alias("copy_class")
    ).distinct()
    described = candidates.select("key", "site", F.md5("text").alias("digest")).distinct()
    classed = stage(described.join(classes, "key"), "line-copies").frame
    several = (
        classed.groupBy("copy_class")
        .agg(F.min("digest").alias("label"), F.min("site").alias("low"), F.max("site").alias("high"))
        .filter("low < high")
    )
    several = stage(several.select("copy_class", "label"), "line-classes")
    if several.fits(BROADCAST_BYTES):
        labelled = classed.join(F.broadcast(several.frame), "copy_class")
    else:
        salted = classed.withColumn("salt", F.pmod(F.col("key"), F.lit(SALTS)))
        labelled = salted.join(_salted(several.frame), ["copy_class", "salt"])
    labelled = stage(labelled.select("key", "site", "copy_class", "label"), "line-labels").frame
    order = F.when(F.col("site").isNotNull(), F.md5(F.concat_ws(":", "label", "site")))
    chosen = labelled.groupBy("copy_class").agg(F.min_by("site", order).alias("one"))
    chosen = stage(chosen, "line-sites")
    keys = labelled.select("key", "copy_class").distinct()
    if chosen.fits(BROADCAST_BYTES):
        return keys.join(F.broadcast(chosen.frame), "copy_class").select("key", "one")
    salted = keys.withColumn("salt", F.pmod(F.col("key"), F.lit(SALTS)))
    return salted.join(_salted(chosen.frame), ["copy_class", "salt"]).select("key", "one")


def _salted(frame: DataFrame) -> DataFrame:
    """Every row of `frame` once for each salt."""
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")
    return frame.withColumn("salt", F.explode(salts))


def _with_lines(lines: DataFrame, shared: Staged) -> DataFrame:
    """Rows of `lines` (key, line) whose line is one of `shared`; a hot line is salted."""
    if shared.fits(BROADCAST_BYTES):
        return lines.join(F.broadcast(shared.frame), "line", "left_semi")
    salted = lines.withColumn("salt", F.pmod(F.col("key"), F.lit(SALTS)))
    return salted.join(_salted(shared.frame), ["line", "salt"], "left_semi").drop("salt")


def _among(hashes: pa.ListArray, known: np.ndarray) -> pa.Array:
    """For every list of hashes which of them are in the sorted array `known`."""
    flat = hashes.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros(len(flat), bool)
    if len(known):
        at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        found = known[at] == flat
    sizes = pc.fill_null(pc.list_value_length(hashes), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(found))


def _marked(rows: DataFrame, hashes: str, key: str, wide: Staged, hits: DataFrame, mark: str):
    """`rows` with `mark`: which of their `hashes` are wide lines; false for all or null: none.

    Wide lines are sent to all tasks, 8 bytes each, up to BROADCAST_BYTES. Beyond that the lines
    to drop are joined to the rows by key.
    """
    if wide.rows * 8 <= BROADCAST_BYTES:
        known = np.sort(wide.frame.toArrow().column("line").to_numpy())
        sent = rows.sparkSession.sparkContext.broadcast(known)

        @F.arrow_udf("array<boolean>")
        def look_up(found: pa.Array) -> pa.Array:
            return _among(found, sent.value)

        return rows.withColumn(mark, look_up(column(hashes)))

    @F.arrow_udf("array<boolean>")
    def compare(found: pa.Array, drops: pa.Array) -> pa.Array:
        marks = []
        for lines, gone in zip(found, drops, strict=True):
            both = lines.is_valid and gone.is_valid
            marks.append(np.isin(lines.values.to_numpy(), gone.values.to_numpy()) if both else None)
        return pa.array(marks, pa.list_(pa.bool_()))

    drops = _with_lines(hits, wide).groupBy(F.col("key").alias(key)).agg(
        F.collect_set("line").alias(mark)
    )
    joined = rows.join(drops, key, "left")
    return joined.withColumn(mark, compare(column(hashes), column(mark)))


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = 10,
    near_percent: int = 80,
    lg_k: int = 12,
    text: str = "text",
    site: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """`docs` without the lines that at least `min_sites` distinct sites share.

    Lines are what stands between line feeds, compared without blanks (U+0020) at their ends;
    blank lines are neither counted nor removed. A class of near-duplicates (five-word shingles,
    `near_percent` hundredths) on several sites is one document, copied: it counts at one of
    them, so copies of a document do not make its lines boilerplate. All other lines count at
    the sites of their texts, and wide ones go from every text, whatever their share of it. All
    columns are kept as they are, but for the text; two columns are added: n_lines and n_removed
    (0 and 0 for a null text, which stays null). Rows are kept, repeated ones too. An empty table
    gives an empty one.
    """
    ship(docs.sparkSession)
    key, hashes, mark = (unused(docs, n) for n in ("line_key", "line_hashes", "line_mark"))
    n_lines, n_removed = "n_lines", "n_removed"
    docs = docs.drop(n_lines, n_removed)
    # Only rows alike in both share a key, and those have the same lines to drop.
    keyed = docs.withColumn(key, F.xxhash64(column(doc_id), column(text)))
    lines = keyed.select(
        F.col(key).alias("key"),
        column(site).alias("site"),
        F.explode(
            F.array_distinct(
                F.transform(F.filter(_pieces(text), lambda x: ~_is_blank(x)), _line_hash)
            )
        ).alias("line"),
    )
    sites = lines.where(F.col("site").isNotNull()).select(
        "line", F.col("site").cast("string").alias("site")
    )
    # Lines that are wide before copies are told apart; only their texts can lose any.
    shared = stage(widespread_lines(sites, min_sites, lg_k), "shared-lines")
    hits = stage(_with_lines(lines, shared).select("key", "site", "line"), "line-hits").frame
    hit_keys = stage(hits.select("key").distinct(), "line-keys")
    few = F.broadcast(hit_keys.frame) if hit_keys.fits(BROADCAST_BYTES) else hit_keys.frame
    candidates = keyed.select(
        F.col(key).alias("key"), column(site).cast("string").alias("site"), column(text).alias("text")
    ).join(few, "key", "left_semi")
    candidates = stage(candidates, "copy-candidates").frame
    copies = stage(_copies(candidates, near_percent), "copies")
    known = F.broadcast(copies.frame) if copies.fits(BROADCAST_BYTES) else copies.frame
    counted_at = F.coalesce("one", F.col("site").cast("string")).alias("site")
    sites = hits.join(known, "key", "left").select("line", counted_at)
    wide = stage(
        widespread_lines(sites.where(F.col("site").isNotNull()), min_sites, lg_k), "wide-lines"
    )
    pieces = _pieces(text)
    hashed = keyed.withColumn(hashes, F.transform(pieces, _line_hash))
    marked = _marked(hashed, hashes, key, wide, hits, mark)
    gone = F.coalesce(F.size(F.filter(mark, lambda hit: hit)), F.lit(0)).cast("bigint")
    counted = marked.withColumns(
        {n_lines: F.coalesce(F.size(pieces), F.lit(0)).cast("bigint"), n_removed: gone}
    )
    kept = F.array_join(F.filter(pieces, lambda _, i: ~F.get(mark, i)), "\n")
    changed = F.when(F.col(n_removed) > 0, kept).otherwise(column(text))
    return counted.withColumn(text, changed).drop(key, hashes, mark)


SQL = """
    WITH RECURSIVE pieces AS (
      SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS pos
      FROM documents),
    lines AS (
      SELECT DISTINCT doc_id, source, trim(line, ' ') AS line FROM pieces
      WHERE trim(line, ' ') <> ''),
    shared AS (
      SELECT line FROM lines GROUP BY line HAVING count(DISTINCT source) >= {min_sites}),
    hits AS (SELECT * FROM lines WHERE line IN (SELECT line FROM shared)),
    words AS (
      SELECT doc_id, source, md5(text) AS digest, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
      FROM documents WHERE doc_id IN (SELECT doc_id FROM hits)),
    shingles AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
      FROM words WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
      WHERE 100 * n_both >= {near_percent} * (a.n + b.n - n_both)),
    reach AS (
      SELECT doc_id, doc_id AS other FROM words
      UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
    classes AS (SELECT doc_id, min(other) AS class FROM reach GROUP BY doc_id),
    labels AS (
      SELECT class, min(digest) AS label FROM classes NATURAL JOIN words
      GROUP BY class HAVING min(source) < max(source)),
    chosen AS (
      SELECT class, min_by(source, md5(label || ':' || source)) AS one
      FROM classes NATURAL JOIN words NATURAL JOIN labels GROUP BY class),
    wide AS (
      SELECT line FROM hits JOIN classes USING (doc_id) LEFT JOIN chosen USING (class)
      GROUP BY line HAVING count(DISTINCT coalesce(one, source)) >= {min_sites}),
    marked AS (
      SELECT p.*, w.line IS NOT NULL AS hit
      FROM pieces p LEFT JOIN wide w ON trim(p.line, ' ') = w.line),
    texts AS (
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_hit,
        string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS text
      FROM marked GROUP BY doc_id)
    SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_hit, 0) AS n_removed,
      CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(t.text, '')) END AS kept_sha256
    FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id"""
