"""Near-duplicates by SimHash: fingerprints that differ in at most three bits are linked.

Meet-in-the-middle ball hashing: two fingerprints three bits apart have a word between them that
is one bit from the one and two from the other. So every fingerprint emits its variants: an even
one (by its number of set bits) all at one bit, an odd one all at one and at two bits. Two that
are two apart meet at one bit from both, two that are one or three apart, one even and one odd,
at one bit and two. All members of a variant's bucket that has a variant at one bit are linked
with that one's owner, so a bucket is a star, never a set of pairs.

Variants are shuffled by their first bits, and a fingerprint goes once to each prefix that its
variants have; the bits behind the prefix are flipped inside the task. A prefix with many entries
is made longer until it has few: a variant's bucket is bounded by the ball around it, so that a
large group of near copies cannot stay together. Tasks return one link for each member of what
they found connected.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.skew import salted_join
from paperloom.functions.staging import BROADCAST_BYTES, stage
from paperloom.llm.common import column, ship, text_groups, written
from paperloom.llm.components import connected_components
from paperloom.llm.words import ASCII_LOWER

RADIUS = 3  # what the parity argument above is made for
SHINGLE = 3  # words
BITS = 64
FIRST_BITS = 10  # of prefixes at least, so that small tables too are dealt over many groups
GROUP_ENTRIES = 16_384  # wanted for each prefix
MOST_ENTRIES = 65_536  # beyond which a prefix is made longer
LONGER, LONGEST = 6, 60  # bits
PROBES = 1 << 20  # variants at two bits that a task holds at a time

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of `size` words; of fewer words the whole sequence is the only run."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([_hash(b" ".join(words))], np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(_hash, runs), np.uint64, len(words) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it; without hashes none is."""
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8)
        votes += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def _fingerprints(batches):
    for columns, texts in text_groups(batches):
        found = np.array([majority(shingle_hashes(t)) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(found.view(np.int64))], ["doc_id", "fp"]
        )


def reach(fingerprints: np.ndarray) -> np.ndarray:
    """How many bits each flips at most: one if it is even, two if it is odd."""
    return 1 + (np.bitwise_count(fingerprints) & 1)


def _masks(width: int, most: int) -> np.ndarray:
    """All words with at most `most` of the lowest `width` bits set."""
    return np.array(
        [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)],
        np.uint64,
    )


def _spread(start: int, stop: int):
    """prefix, fp: each fingerprint at all prefixes of `stop` bits that its variants have.

    Prefixes of `start` bits are given; flips that they hold already are counted.
    """
    masks = _masks(stop - start, 2)
    flips = np.bitwise_count(masks)

    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(False).view(np.uint64)
            before = batch.column("prefix").to_numpy(False).view(np.uint64)
            whole = fp >> np.uint64(BITS - stop)
            spent = np.bitwise_count(before ^ (whole >> np.uint64(stop - start)))
            left = reach(fp) - spent
            own = (before << np.uint64(stop - start)) | (whole & np.uint64((1 << stop - start) - 1))
            for part in range(0, len(fp), 8192):
                at = slice(part, part + 8192)
                row, mask = np.nonzero(flips[None, :] <= left[at, None])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((own[at][row] ^ masks[mask]).view(np.int64)),
                        pa.array(fp[at][row].view(np.int64)),
                    ],
                    ["prefix", "fp"],
                )

    return run


def _join_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after linking u with v; a label is the smallest member of what is connected."""
    while len(u):
        a, b = label[u], label[v]
        differ = a != b
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def _flipped(base: np.ndarray, owner: np.ndarray, masks: np.ndarray) -> tuple:
    return (base[:, None] ^ masks[None, :]).ravel(), np.repeat(owner, len(masks))


def meet(fp: np.ndarray, prefix: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the fingerprints whose variants with this prefix meet, one for each member."""
    fp = np.unique(fp)
    low = BITS - bits
    base = (np.uint64(prefix) << np.uint64(low)) | (fp & np.uint64((1 << low) - 1))
    spent, most = np.bitwise_count(base ^ fp), reach(fp)
    member = np.arange(len(fp))
    one = np.array([1 << i for i in range(low)], np.uint64)
    two = np.array([(1 << i) | (1 << j) for i, j in combinations(range(low), 2)], np.uint64)
    none = np.zeros(1, np.uint64)
    label = np.arange(len(fp))

    # Variants at one bit: all owners of one are two apart.
    parts = [_flipped(base[spent == s], member[spent == s], m) for s, m in ((0, one), (1, none))]
    variant, owner = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(variant, kind="stable")
    variant, owner = variant[order], owner[order]
    same = np.flatnonzero(variant[1:] == variant[:-1])
    label = _join_labels(label, owner[same], owner[same + 1])
    if not len(variant):
        return fp[:0], fp[:0]

    # Variants at two bits, of odd fingerprints, meet those at one bit of even ones.
    for s, masks in ((0, two), (1, one), (2, none)):
        chosen = np.flatnonzero((spent == s) & (most == 2))
        step = max(1, PROBES // len(masks))
        for start in range(0, len(chosen), step):
            part = chosen[start : start + step]
            probe, prober = _flipped(base[part], part, masks)
            near = np.minimum(np.searchsorted(variant, probe), len(variant) - 1)
            hit = variant[near] == probe
            u, v = prober[hit], owner[near[hit]]
            close = np.bitwise_count(fp[u] ^ fp[v]) <= RADIUS  # by construction; verified still
            label = _join_labels(label, u[close], v[close])
    moved = np.flatnonzero(label != member)
    return fp[label[moved]], fp[moved]


def _meet(group: pa.Table) -> pa.Table:
    bits, prefix = group.column("bits")[0].as_py(), group.column("prefix")[0].as_py()
    fp = group.column("fp").combine_chunks().to_numpy(False).view(np.uint64)
    u, v = meet(fp, prefix, bits)
    return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})


def first_bits(n: int) -> int:
    """Length of prefixes at which n evenly spread fingerprints make groups of the wanted size.

    A fingerprint has about bits * bits / 4 prefixes: that number grows with the square of the
    logarithm of n, whatever groups of near copies there are.
    """
    for bits in range(FIRST_BITS, LONGEST):
        each = 1 + bits + bits * (bits - 1) / 4  # half of them are odd
        if n * each / 2**bits <= GROUP_ENTRIES:
            return bits
    return LONGEST


def near_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """u, v: links among the distinct values of `fp`, enough to connect all at three bits or less."""
    bits = first_bits(fingerprints.count())
    schema = "prefix long, fp long"
    start = fingerprints.select(F.lit(0).cast("long").alias("prefix"), "fp")
    entries = written(start.mapInArrow(_spread(0, bits), schema), "variants")
    parts = []
    while bits + LONGER <= LONGEST:
        many = entries.groupBy("prefix").count().filter(F.col("count") > MOST_ENTRIES)
        many = stage(many.select("prefix"), "large-prefixes")
        if not many.rows:
            break
        side = F.broadcast(many.frame) if many.fits(BROADCAST_BYTES) else many.frame
        parts.append(entries.join(side, "prefix", "left_anti").withColumn("bits", F.lit(bits)))
        longer = entries.join(side, "prefix", "left_semi")
        entries = written(longer.mapInArrow(_spread(bits, bits + LONGER), schema), "variants")
        bits += LONGER
    groups = entries.withColumn("bits", F.lit(bits))
    for part in parts:
        groups = groups.unionByName(part)
    return groups.groupBy("bits", "prefix").applyInArrow(_meet, "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of `docs`.

    ASCII letters count in lower case; words are runs of characters that are no ASCII white
    space. A fingerprint has the bits that more than half of the hashes of a text's runs of three
    words have, repeats included. Fewer words are one run; null, empty and wordless texts have
    fingerprint zero and are linked like any other. Rows are linked if their fingerprints differ
    in at most three bits; component_id is the smallest doc_id that links reach, the row's own
    included. No link is missed, whatever the size of a group. Rows without doc_id take part but
    name no component: alone they have a null one. Repeated rows are all returned; columns of
    other names do not matter; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(column(key).cast("long").alias("doc_id"), column(text).alias("text"))
    found = rows.mapInArrow(_fingerprints, "doc_id long, fp long")
    # The place tells the rows of one fingerprint apart where they are dealt out.
    found = written(found.withColumn("place", F.monotonically_increasing_id()), "fingerprints")
    # One row a fingerprint, combined on the map side: copies are no group anywhere below.
    distinct = written(found.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct")
    links = written(near_fingerprints(distinct.select("fp")), "links")
    known = written(
        distinct.join(connected_components(links), F.col("fp") == F.col("node"), "left").select(
            "fp", "smallest", F.coalesce("component", "fp").alias("component")
        ),
        "components",
    )
    least = known.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = known.join(least, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return salted_join(found, named, "fp", F.col("place")).select(
        "doc_id", digits.alias("fingerprint"), "component_id"
    )
