"""Near-duplicates by MinHash with tensored banding; every link is verified on full sets.

Two collections of m short keys, each made of r minimum hashes, give m * m tables: the key of
table (i, j) joins key i of the one with key j of the other. That is the recall and precision of
m * m bands of 2 r rows for 2 m r hashes instead of 2 m * m * r.

Documents with equal sets are one class from the start. Keys that a single class has are left
out before tables are formed. A bucket then proposes one link a member, to its smallest one; the
most frequent proposal of each class is verified and the components taken. What is left are
buckets that still hold several components: their members are compared in blocks, inside tasks,
and only links between components leave those. No pair list of a group is ever written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.staging import BROADCAST_BYTES, stage
from paperloom.llm.common import (
    GROUP_BYTES,
    batch_slices,
    column,
    ship,
    text_groups,
    unused,
    utf8_values,
    written,
)
from paperloom.llm.components import connected_components
from paperloom.llm.words import ASCII_LOWER, mix, texts_to_words, windows

SHINGLE = 5  # words
ROWS, COLLECTIONS = 4, 16  # hashes in a short key, keys in a collection
BLOCK_MEMBERS = 1000  # of a group compared in one task
SALTS = 64  # over which the proposals for one class are spread
SEED = 11


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of `size` words, ASCII letters in lower case.

    A text of fewer words has its whole sequence as its only one; a text without words none.
    """
    words, ends = texts_to_words(texts, ASCII_LOWER)
    hashed = windows(words, size)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(hashed[a : b - size + 1]))
        elif b > a:
            short = windows(words[a:b], b - a) ^ np.uint64(b - a)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def similar(shared: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int):
    """Is the intersection at least `percent` of a hundred parts of the union?"""
    return 100 * shared >= percent * (size_a + size_b - shared)


def _multipliers() -> np.ndarray:
    random = np.random.default_rng(SEED)
    return random.integers(0, 2**63, 2 * ROWS * COLLECTIONS, np.int64).astype(np.uint64) * np.uint64(
        2
    ) + np.uint64(1)


def short_keys(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, none of them empty, its 2 m short keys; each is marked by its number."""
    factors = _multipliers()
    out = np.empty((len(sets), len(factors)), np.uint64)
    sizes = np.array([len(s) for s in sets])
    start = 0
    while start < len(sets):  # about as much as fits the processor's cache
        stop = max(start + 1, int(np.searchsorted(np.cumsum(sizes[start:]), 1 << 15)) + start)
        flat = np.concatenate(sets[start:stop])
        firsts = np.concatenate([[0], np.cumsum(sizes[start : stop - 1])])
        for i, factor in enumerate(factors):
            product = flat * factor
            product ^= product >> np.uint64(32)
            out[start:stop, i] = np.minimum.reduceat(product, firsts)
        start = stop
    keys = np.zeros((len(sets), 2 * COLLECTIONS), np.uint64)
    for number in range(2 * COLLECTIONS):
        key = np.full(len(sets), number, np.uint64)
        for row in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + out[:, number * ROWS + row])
        keys[:, number] = key
    return keys


_SETS = "doc_id long, source long, text_hash long, n_shingles long, class long, keys array<long>"


def _describe(batches):
    """Of each document: size and hash of its set, and its short keys."""
    for columns, texts in text_groups(batches):
        sets = shingle_sets(texts)
        filled = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        classes: list = [None] * len(sets)
        if filled:
            found = short_keys([sets[i] for i in filled]).view(np.int64).tolist()
            for i, k in zip(filled, found, strict=True):
                keys[i] = k
                digest = xxhash.xxh3_64_intdigest(sets[i].tobytes())
                classes[i] = digest - (1 << 64) if digest >> 63 else digest
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(classes, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            ["doc_id", "source", "text_hash", "n_shingles", "class", "keys"],
        )


def _live_keys(classes: DataFrame) -> DataFrame:
    """class, a, b: short keys of either collection that another class has too."""
    both = classes.select("class", F.posexplode("keys").alias("number", "key"))
    others = Window.partitionBy("key")
    shared = (
        both.withColumn("classes", F.count(F.lit(1)).over(others))
        .filter("classes > 1")
        .groupBy("class")
        .agg(
            F.collect_set(F.when(F.col("number") < COLLECTIONS, F.col("key"))).alias("a"),
            F.collect_set(F.when(F.col("number") >= COLLECTIONS, F.col("key"))).alias("b"),
        )
    )
    return shared.filter((F.size("a") > 0) & (F.size("b") > 0))


def _tables(live: DataFrame) -> DataFrame:
    """bucket, class, a: membership in the buckets of all tables."""
    return (
        live.select("class", F.explode("a").alias("a"), "b")
        .select("class", "a", F.explode("b").alias("b"))
        .select(F.xxhash64("a", "b").alias("bucket"), "class", "a")
    )


def _proposals(live: DataFrame) -> DataFrame:
    """u, v: each class with the smallest member of its buckets that it meets most often."""
    in_bucket = Window.partitionBy("bucket")
    met = (
        _tables(live)
        .select("class", F.min("class").over(in_bucket).alias("first"))
        .filter(F.col("first") < F.col("class"))
        .groupBy("class", "first")
        .count()
    )
    best = F.max(F.struct("count", (-F.col("first")).alias("order"), "first")).alias("best")
    return met.groupBy("class").agg(best).select(F.col("class").alias("u"), F.col("best.first").alias("v"))


def _verify(percent: int):
    """Keep the pairs whose sets are similar enough."""

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            u, v = batch.column(names.index("u")), batch.column(names.index("v"))
            held: dict[int, np.ndarray] = {}
            keep = np.zeros(batch.num_rows, bool)
            start = 0
            for part in batch_slices([batch], names.index("text_u"), GROUP_BYTES // 2):
                n = part.num_rows
                own = shingle_sets(utf8_values(part.column(names.index("text_u"))))
                at = v.slice(start, n).to_pylist()
                texts = part.column(names.index("text_v"))
                new = {c: i for i, c in enumerate(at) if c not in held}
                if len(held) > 200:
                    held, new = {}, {c: i for i, c in enumerate(at)}
                picked = utf8_values(texts.take(pa.array(list(new.values()), pa.int64())))
                held.update(zip(new, shingle_sets(picked), strict=True))
                for i, (a, c) in enumerate(zip(own, at, strict=True)):
                    b = held[c]
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                    keep[start + i] = similar(shared, len(a), len(b), percent)
                start += n
            kept = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([u.take(kept), v.take(kept)], ["u", "v"])

    return run


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of blocks of the membership matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = many[code] > 1
    owner, code = owner[several], code[several]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], np.unique(code[order], return_inverse=True)[1]
    counts = np.diag([len(s) for s in sets]).astype(np.float32)
    shared = np.zeros_like(counts)
    width = 2048
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [low, low + width])
        member = np.zeros((len(sets), width), np.float32)
        member[owner[a:b], code[a:b] - low] = 1
        shared += member @ member.T
    return shared.astype(np.int64)


def _compare_block(percent: int):
    """Links between different components among the members of a block; one for each two."""

    def run(group: pa.Table) -> pa.Table:
        members = dict(
            zip(
                group.column("class").to_pylist(),
                zip(
                    group.column("component").to_pylist(),
                    utf8_values(group.column("text").combine_chunks()),
                    strict=True,
                ),
                strict=True,
            )
        )
        names = np.array(list(members), np.int64)
        components = np.array([c for c, _ in members.values()], np.int64)
        sets = shingle_sets([t for _, t in members.values()])
        sizes = np.array([len(s) for s in sets])
        near = similar(_shared_counts(sets), sizes[:, None], sizes[None, :], percent)
        near &= components[:, None] < components[None, :]
        i, j = np.nonzero(near)
        pairs = np.column_stack([components[i], components[j]])
        _, first = np.unique(pairs, axis=0, return_index=True)
        return pa.table({"u": pa.array(names[i[first]]), "v": pa.array(names[j[first]])})

    return run


def _remaining(live: DataFrame, components: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between classes that share a bucket but are not known to belong together."""
    named = live.join(components, F.col("class") == F.col("node"), "left").select(
        "class", "a", "b", F.coalesce("component", "class").alias("component")
    )
    members = (
        named.select("class", "component", F.explode("a").alias("a"), "b")
        .select("class", "component", "a", F.explode("b").alias("b"))
        .select("class", "component", "a", F.xxhash64("a", "b").alias("bucket"))
    )
    in_bucket = Window.partitionBy("bucket")
    mixed = written(
        members.withColumns(
            {
                "low": F.min("component").over(in_bucket),
                "high": F.max("component").over(in_bucket),
            }
        )
        .filter("low < high")
        .groupBy("a", "class")
        .agg(F.first("component").alias("component")),
        "mixed-buckets",
    )
    # A large group is compared block by block: a member goes to every pair with its own block.
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).cast("int").alias("blocks")
    large = stage(mixed.groupBy("a").agg(blocks).filter("blocks > 1"), "large-groups")
    sizes = F.broadcast(large.frame) if large.fits(BROADCAST_BYTES) else large.frame
    own = F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int")
    placed = (
        mixed.join(sizes, "a", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "a",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "class",
            "component",
        )
    )
    return (
        placed.join(texts, "class")
        .groupBy("a", "low", "high")
        .applyInArrow(_compare_block(percent), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash (xxhash64) and group of every row of `docs`.

    Texts are sets of five-word shingles; two are linked if their intersection is at least
    `percent` hundredths of their union. component_id is the smallest doc_id that links reach,
    the row's own included; kept says whether it is the row's own. Null texts and texts without
    words have empty sets and are linked with nothing. Rows without doc_id take part, but name no
    component: alone they have a null one and are kept. Repeated rows are kept alike. group tells
    components apart also where they share their smallest doc_id, or have none; it is null for
    an empty set. Columns of other names do not matter; an empty table gives an empty result.

    All links are verified on full sets. A pair just at the limit of 85 % meets in no bucket with
    a probability of 0.000015, at 80 % with 0.0004; it is then missed unless others connect it.
    Sets are told apart by 64-bit hashes.
    """
    ship(docs.sparkSession)
    text_column = column(text)
    # A text is fetched again by its source: the doc_id, or a hash where there is none.
    source = F.coalesce(column(key).cast("long"), F.xxhash64(text_column))
    rows = docs.select(
        column(key).cast("long").alias("doc_id"),
        source.alias("source"),
        F.xxhash64(text_column).alias("text_hash"),
        text_column.alias("text"),
    )
    sets = written(rows.mapInArrow(_describe, _SETS), "shingle-sets")
    classes = (
        sets.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("source").alias("source"), F.min_by("keys", "source").alias("keys"))
    )
    live = written(_live_keys(classes), "live-keys")
    sources = (
        sets.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("source").alias("source"))
        .join(live.select("class"), "class", "left_semi")
    )

    def read_class(batches):
        """Drop texts of the same source but another set."""
        for columns, found in text_groups(batches):
            for wanted, value in zip(columns[0], found, strict=True):
                digest = xxhash.xxh3_64_intdigest(shingle_sets([value])[0].tobytes())
                if (digest - (1 << 64) if digest >> 63 else digest) == wanted:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([wanted], pa.int64()), pa.array([value.decode()], pa.string())],
                        ["class", "text"],
                    )

    texts = written(
        rows.select("source", "text")
        .join(sources, "source")
        .select("class", "text")
        .mapInArrow(read_class, "class long, text string")
        .dropDuplicates(["class"]),
        "candidate-texts",
    )
    proposals = written(
        _proposals(live).withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS))), "proposals"
    )
    leaders = (
        proposals.select(F.col("v").alias("class"), "salt")
        .distinct()
        .join(texts, "class")
        .select(F.col("class").alias("v"), "salt", F.col("text").alias("text_v"))
    )
    links = written(
        proposals.join(texts.select(F.col("class").alias("u"), F.col("text").alias("text_u")), "u")
        .join(leaders, ["v", "salt"])
        .select("u", "v", "text_u", "text_v")
        .mapInArrow(_verify(percent), "u long, v long"),
        "links",
    )
    first = connected_components(links)
    more = written(_remaining(live, first, texts, percent), "more-links")
    components = first if more.isEmpty() else connected_components(links.unionByName(more))
    known = (
        sets.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("smallest"))
        .join(components, F.col("class") == F.col("node"), "left")
        .select("class", "smallest", F.coalesce("component", "class").alias("component"))
    )
    known = written(known, "classes")
    smallest = known.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = known.join(smallest, "component").select(
        "class", "component_id", F.col("component").alias("group")
    )
    result = sets.select("doc_id", "text_hash", "n_shingles", "class").join(named, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
        "group",
    )


def drop_near_duplicates(
    docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with one row of each group of near-duplicates, that with the smallest id.

    Rows with empty sets all stay. Where several texts of a group share the smallest id, or no
    row of it has an id, the text with the smallest xxhash64 stays, once. Groups of other texts
    keep a row of their own even if their ids are alike. All columns are kept as they are.
    """
    names = [unused(docs, n) for n in ("near_mark", "near_row", "near_text", "near_hash")]
    mark, row, hashed, own = names
    found = near_duplicates(docs, percent, key, text)
    # One row for each group, found on narrow rows; a row without words needs no decision.
    texts_of = (
        found.filter(F.col("kept") & F.col("group").isNotNull())
        .groupBy("group", "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    first = F.min(F.struct("text_hash", "doc_id", "rows")).alias("first")
    kept = (
        texts_of.groupBy("group")
        .agg(first)
        .select(
            F.col("first.doc_id").alias(row),
            F.col("first.text_hash").alias(hashed),
            F.col("first.rows").alias(mark),
        )
    )
    words = F.coalesce(column(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    chosen = (
        docs.filter(words)
        .withColumn(own, F.xxhash64(column(text)))
        .join(kept, column(key).eqNullSafe(F.col(row)) & (F.col(own) == F.col(hashed)))
    )
    once = chosen.filter(F.col(mark) == 1)
    several = chosen.filter(F.col(mark) > 1).dropDuplicates([key, text])
    return (
        once.unionByName(several).select(*[column(c) for c in docs.columns])
        .unionByName(docs.filter(~words))
    )
