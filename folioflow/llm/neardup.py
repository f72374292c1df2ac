"""Near-duplicate texts: sets of three-word sequences that are alike.

Equal texts form one class with one representative. Candidates among the
representatives come from min-hash bands. Each representative has a
fingerprint, the bits that its sequences hash to, and a pivot table: its
Hamming distances to PIVOTS reference fingerprints, computed beforehand. The
distance of two fingerprints is never more than the number of sequences that
only one of the texts has, and the difference of two distances to a pivot
never more than that (triangle inequality). So a candidate pair is discarded
without loss if the pivot tables differ somewhere by more than the threshold
allows for texts of that size, then by the distance itself; survivors are
verified on the sets.

Pivot distances alone can't find the candidates at a similarity of 0.4: the
allowed distance is larger than nearly all coordinate differences between
unrelated texts. Hence the bands; see the README for the measured shares.

Edge cases: null texts and texts under `least` words have no pairs; equal
texts are pairs; repeated rows count once; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import cut_lineage

#: Min-hashes, and the bands of ROWS of them each; every min-hash is in two bands. A pair of similarity 0.4 is a candidate with probability 0.903, of 0.45 with 0.974, of 0.5 with 0.995 (simulated).
MINHASHES, BANDS, ROWS = 192, 96, 4
#: Reference fingerprints, and bits of a fingerprint.
PIVOTS, BITS = 32, 256
#: Band rows of a bucket, about. Marks of a row: its key has others in its batch (one such row stands for them), or that is known and nothing more is to be found out.
BUCKET_ROWS, SHARED, KNOWN = 1 << 14, 1, 2
#: Rows of a group that one task pairs with as many others.
BLOCK = 512
_WORD = re.compile(r"[^\W_]+")


_APART = {i: c if (c := chr(i).lower()).isalnum() else " " for i in range(128)}


def words(text: str) -> list[str]:
    return text.translate(_APART).split() if text.isascii() else _WORD.findall(text.lower())


@lru_cache(maxsize=500_000)
def _word_hash(w: str) -> int:
    return int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")


def shingle_sets(texts: list[list[str]], k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct sequences of k words of each text, sorted, as one array and its offsets; mixed from one 64-bit hash per word. Texts have k words at least."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.fromiter(map(_word_hash, chain.from_iterable(texts)), np.uint64, int(lengths.sum()))
    text = np.repeat(np.arange(len(texts)), lengths)
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    inside = text[:n] == text[k - 1 :]
    both = np.unique((text[:n][inside].astype(np.uint64) << np.uint64(32)) | (out[inside] >> np.uint64(32)))
    offsets = np.searchsorted(both, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    return (both & np.uint64(0xFFFFFFFF)).astype("<u4"), offsets


def shingles(ws: list[str], k: int = 3) -> np.ndarray:
    return shingle_sets([ws], k)[0]


def _permutations(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minhashes(flat: np.ndarray, offsets: np.ndarray, perms: tuple[np.ndarray, np.ndarray], step: int = 64) -> np.ndarray:
    """The least 32-bit hash of each set under each permutation, some sets at a time. Without the second mixing step they would depend on one another."""
    a, b = perms
    out = np.empty((len(offsets) - 1, len(a)), np.uint64)
    for i in range(0, len(out), step):
        at = offsets[i : i + step + 1]
        h = flat[at[0] : at[-1]].astype(np.uint32)[:, None] * a
        t = h >> np.uint32(15)
        t ^= b
        h ^= t
        h *= np.uint32(0x85EBCA6B)
        np.right_shift(h, np.uint32(13), out=t)
        h ^= t
        out[i : i + step] = np.minimum.reduceat(h, at[:-1] - at[0], axis=0)
    return out


def _bands(seed: int = 13) -> np.ndarray:
    """The min-hashes of each band: those of one permutation in turn, then those of another."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.permutation(MINHASHES).reshape(-1, ROWS) for _ in range(BANDS * ROWS // MINHASHES)])


_BANDS = _bands()


def band_keys(low: np.ndarray) -> np.ndarray:
    """A key per text (rows of min-hashes) and band: the band's number above 32 hashed bits of its min-hashes."""
    low = low[:, _BANDS]
    key = np.full(low.shape[:2], 0x9E3779B97F4A7C15, np.uint64)
    for i in range(ROWS):
        key = (key ^ low[:, :, i]) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(29)
    return (np.arange(BANDS, dtype=np.int64) << 32) | (key >> np.uint64(32)).astype(np.int64)


def fingerprints(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bits that each set's hashes fall on, as rows of bytes. Sets that differ in n members have a distance of n at most."""
    bits = np.zeros((len(offsets) - 1, BITS), np.uint8)
    bits[np.repeat(np.arange(len(bits)), np.diff(offsets)), flat % BITS] = 1
    return np.packbits(bits, axis=1)


def fingerprint(s: np.ndarray) -> np.ndarray:
    return fingerprints(s, np.array([0, len(s)]))[0]


def _blobs(rows: np.ndarray, offsets: np.ndarray | None = None) -> pa.Array:
    """Each row of a matrix, or each stretch of an array between offsets, as bytes."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1) * rows[:1].nbytes if offsets is None else offsets * rows.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(rows)]).cast(pa.binary())


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[a ^ b].sum(axis=-1)


def allowed_distance(size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> np.ndarray:
    """The distance that a pair of the threshold has at most: (1 - t) / (1 + t) of both sizes."""
    return (1 - threshold) / (1 + threshold) * (size_a.astype(np.int64) + size_b)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


MEMBERS = "field string, id bigint, class_id string, words string"


def class_rows(fields: pa.Array, ids: pa.Array, texts: list[str | None], least: int) -> pa.RecordBatch:
    """MEMBERS rows of a batch of texts: the class is the digest of the words; texts under `least` words are left out."""
    ws = [words(t) if t else [] for t in texts]
    keep = [i for i, w in enumerate(ws) if len(w) >= max(1, least)]
    joined = [" ".join(ws[i]) for i in keep]
    digests = [hashlib.blake2b(j.encode(), digest_size=16).hexdigest() for j in joined]
    at = pa.array(keep, pa.int32())
    return pa.RecordBatch.from_arrays([fields.take(at), ids.take(at), pa.array(digests, pa.string()), pa.array(joined, pa.string())], ["field", "id", "class_id", "words"])


def classes(texts: DataFrame, least: int) -> DataFrame:
    """MEMBERS rows of (field, id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield class_rows(b.column(0), b.column(1), b.column(2).to_pylist(), least)

    some = texts.filter(F.length("text") >= 2 * least - 1).select("field", "id", "text")
    return some.mapInArrow(run, MEMBERS)


def reference_fingerprints(members: DataFrame, k: int) -> np.ndarray:
    """PIVOTS fingerprints of texts of the collection, those with the least digests, as rows of bytes; the empty one is the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _blobs(fingerprints(*shingle_sets([w.split(" ") for w in b.column(1).to_pylist()], k)))], ["class_id", "print"])

    some = members.select("class_id", "words").dropDuplicates(["class_id"]).orderBy("class_id").limit(PIVOTS - 1)
    prints = [bytes(r.print) for r in some.mapInArrow(run, "class_id string, print binary").orderBy("class_id").collect()]
    return np.frombuffer(b"".join([bytes(BITS // 8), *prints]), np.uint8).reshape(-1, BITS // 8)


def profiles(reps: DataFrame, k: int, pivots: np.ndarray) -> DataFrame:
    """(field, rep, size, shingles, print, pivots) of each representative."""
    shared = reps.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat, offsets = shingle_sets([w.split(" ") for w in b.column(2).to_pylist()], k)
            prints = fingerprints(flat, offsets)
            tables = np.minimum(255, np.stack([hamming(prints, p) for p in shared.value], axis=1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(offsets), pa.int32()), _blobs(flat, offsets), _blobs(prints), _blobs(tables)], ["field", "rep", "size", "shingles", "print", "pivots"])

    return reps.select("field", "rep", "words").mapInArrow(run, "field string, rep bigint, size int, shingles binary, print binary, pivots binary")


def packed(keys: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, int]:
    """A row of bytes for each pair: five of the key, and as many of the other number as the largest one needs."""
    width = 8 if (reps < 0).any() else max(1, (int(reps.max(initial=0)).bit_length() + 7) // 8)
    return np.concatenate([x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :n] for x, n in ((keys, 5), (reps, width))], axis=1), width


def unpacked(rows: bytes, width: int) -> np.ndarray:
    """The pairs again, as two columns."""
    flat = np.frombuffer(rows, np.uint8).reshape(-1, 5 + width)
    out = np.zeros((len(flat), 16), np.uint8)
    out[:, :5], out[:, 8 : 8 + width] = flat[:, :5], flat[:, 5:]
    return out.view("<i8")


def band_buckets(profile: DataFrame, buckets: int) -> DataFrame:
    """(bucket, width, rows): the band rows of the representatives by their keys, packed: the key, and the representative with a mark.

    Of a key that has several rows in a batch, one goes to the key's bucket,
    marked SHARED, the others, marked KNOWN, to buckets in turn. So no bucket
    gathers the rows of a frequent key.
    The field is mixed into the key, and told apart again by the join with the profiles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = _permutations(MINHASHES)
        for b in batches:
            if not b.num_rows:
                continue
            mix = np.array([zlib.crc32(f.encode()) for f in b.column(0).to_pylist()], np.int64)
            sets = b.column(2).to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(s) // 4 for s in sets])])
            keys = (band_keys(minhashes(np.frombuffer(b"".join(sets), "<u4"), offsets, perms)) ^ mix[:, None]).ravel()
            order = np.argsort(keys)
            keys, reps = keys[order], np.repeat(b.column(1).to_numpy(zero_copy_only=False), BANDS)[order]
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            alone = new & np.concatenate([new[1:], [True]])
            mark = np.where(alone, 0, np.where(new, SHARED, KNOWN))
            bucket = np.where(mark == KNOWN, np.arange(len(keys)), keys) & (buckets - 1)
            order = np.argsort(bucket, kind="stable")
            rows, width = packed(keys[order], reps[order] * 4 + mark[order])
            of, first = np.unique(bucket[order], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.full(len(of), width, np.int32)), _blobs(rows.ravel(), np.append(first, len(rows)) * (5 + width))], ["bucket", "width", "rows"])

    return profile.select("field", "rep", "shingles").mapInArrow(run, "bucket bigint, width int, rows binary")


def shared_keys(buckets: DataFrame) -> DataFrame:
    """The band rows (key, rep) whose key has another one. Nearly all are alone; they go here, a bucket at a time."""

    def shared(rows: np.ndarray) -> pa.RecordBatch:
        key, rep, mark = rows[:, 0], rows[:, 1] >> 2, rows[:, 1] & 3
        known = mark == KNOWN
        order = np.flatnonzero(~known)
        order = order[np.argsort(key[order])]
        k = key[order]
        same = k[1:] == k[:-1]
        keep = mark[order] == SHARED
        keep[1:] |= same
        keep[:-1] |= same
        at = np.concatenate([order[keep], np.flatnonzero(known)])
        return pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(rep[at])], ["key", "rep"])

    def whole(rows: list[tuple[int, bytes]]) -> np.ndarray:
        return np.concatenate([unpacked(b"".join(r for w, r in rows if w == width), width) for width in {w for w, _ in rows}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, open_ = [], None  # rows of the bucket that the next batch may go on with
        for b in batches:
            of = b.column(0).to_numpy(zero_copy_only=False)
            rows = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
            if not rows:
                continue
            ends = int(np.searchsorted(of, of[-1]))  # rows of the last bucket begin here
            if ends or open_ != of[-1]:
                if done := held + rows[:ends]:
                    yield shared(whole(done))
                held = []
            held += rows[ends:]
            open_ = of[-1]
        if held:
            yield shared(whole(held))

    return buckets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "key bigint, rep bigint")


def pairs_within(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """(group, a, b): the pairs a < b of each group.

    A large group is cut into blocks of BLOCK rows, and each pair of blocks is
    a key of its own, so that no task has more than BLOCK * BLOCK pairs of it.
    Rows that are alone go before anything is joined.
    """
    whole = Window.partitionBy(*group)
    numbered = rows.withColumn("no", F.row_number().over(whole.orderBy(key)) - 1).withColumn("n", F.count("*").over(whole)).filter("n > 1")
    block, last = F.floor(F.col("no") / BLOCK).cast("int"), F.floor((F.col("n") - 1) / BLOCK).cast("int")
    numbered = cut_lineage(numbered.select(*group, key, block.alias("block"), last.alias("last")))
    lower = numbered.select(*group, F.col(key).alias("a"), F.col("block").alias("x"), F.explode(F.sequence("block", "last")).alias("y"))
    upper = numbered.select(*group, F.col(key).alias("b"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("x"), F.col("block").alias("y"))
    return lower.join(upper, [*group, "x", "y"]).filter("a < b").select(*group, "a", "b")


def candidates(profile: DataFrame) -> DataFrame:
    """(a, b) with a < b that share a band."""
    rows = profile.count() * BANDS
    buckets = 1 << max(8, (rows // BUCKET_ROWS).bit_length())
    return pairs_within(shared_keys(band_buckets(profile, buckets)), ["key"], "rep").select("a", "b").distinct()


def near_by_prints(pairs: DataFrame, profile: DataFrame, threshold: float, measure: bool = False) -> DataFrame:
    """The candidates whose fingerprints are near: the pivot table discards first, the distance itself then.

    With measure, all pairs come back with `stage`: pivot, distance or kept.
    """
    side = lambda x: profile.select("field", F.col("rep").alias(x), F.col("size").alias(f"n_{x}"), F.col("print").alias(f"f_{x}"), F.col("pivots").alias(f"p_{x}"))
    wide = pairs.join(side("a"), "a").join(side("b"), ["field", "b"]).select("field", "a", "b", "n_a", "n_b", "f_a", "f_b", "p_a", "p_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            read = lambda c, t: np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, -1)  # noqa: B023, E731
            most = allowed_distance(batch.column(3).to_numpy(), batch.column(4).to_numpy(), threshold)
            near = np.abs(read(7, np.uint8).astype(np.int16) - read(8, np.uint8)).max(axis=1, initial=0) <= most
            kept = near & (hamming(read(5, np.uint8), read(6, np.uint8)) <= most)
            stage = np.where(kept, "kept", np.where(near, "distance", "pivot"))
            at = pa.array(np.arange(n) if measure else np.flatnonzero(kept), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(3)), pa.array(stage.tolist(), pa.string()).take(at)], ["field", "a", "b", "stage"])

    out = wide.mapInArrow(run, "field string, a bigint, b bigint, stage string")
    return out if measure else out.drop("stage")


def verified(pairs: DataFrame, profile: DataFrame, threshold: float) -> DataFrame:
    """The survivors of at least the threshold by their shingle sets: (field, a, b, similarity)."""
    side = lambda x: profile.select("field", F.col("rep").alias(x), F.col("shingles").alias(f"s_{x}"))
    wide = pairs.join(side("a"), ["field", "a"]).join(side("b"), ["field", "b"]).select("field", "a", "b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sim = np.array([jaccard(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist())], np.float64)
            at = pa.array(np.flatnonzero(sim >= threshold), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(3)), pa.array(sim).take(at)], ["field", "a", "b", "similarity"])

    return wide.mapInArrow(run, "field string, a bigint, b bigint, similarity double")


def near_duplicates(texts: DataFrame, threshold: float = 0.8, k: int = 5, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """Pairs of class representatives (field, a, b, similarity) and membership (field, id, rep).

    texts: (field, id, text), in any number of rows per id, or MEMBERS rows of such. Not complete: a pair
    of similarity 0.4 is a candidate with probability 0.903, see BANDS.
    """
    members = cut_lineage(texts if "class_id" in texts.columns else classes(texts, max(least, k)))
    reps = members.groupBy("field", "class_id").agg(F.min("id").alias("rep"), F.first("words").alias("words"))
    profile = cut_lineage(profiles(reps, k, reference_fingerprints(members, k)))
    pairs = verified(near_by_prints(candidates(profile), profile, threshold), profile, threshold)
    membership = members.select("field", "id", "class_id").distinct().join(reps.select("field", "class_id", "rep"), ["field", "class_id"]).select("field", "id", "rep")
    return pairs, membership


def all_pairs(pairs: DataFrame, membership: DataFrame) -> DataFrame:
    """Every pair of ids (field, id_a, id_b): copies in one class, and members of similar classes."""
    m = cut_lineage(membership)
    same = pairs_within(m, ["field", "rep"], "id").select("field", F.col("a").alias("i"), F.col("b").alias("j"))
    across = pairs.join(m.select("field", F.col("rep").alias("a"), F.col("id").alias("i")), ["field", "a"]).join(m.select("field", F.col("rep").alias("b"), F.col("id").alias("j")), ["field", "b"])
    both = same.unionByName(across.select("field", "i", "j"))
    return both.select("field", F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b")).distinct()


def groups(pairs: DataFrame, membership: DataFrame) -> DataFrame:
    """(field, id, group_id, links): the connected groups, one row per id; copies share class and links.

    Labels spread along the links and jump to their label's label, so the
    rounds grow with the logarithm of a chain's length. Each round is written
    as a table; only the number of changes comes to the driver.
    """
    links = cut_lineage(pairs.select("field", "a", "b").unionByName(pairs.select("field", F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = links.select("field", F.col("a").alias("rep")).distinct().withColumn("label", F.col("rep"))
    while True:
        labels = cut_lineage(labels)
        of = labels.select("field", F.col("rep").alias("b"), F.col("label").alias("next"))
        least = links.join(of, ["field", "b"]).groupBy("field", F.col("a").alias("rep")).agg(F.min("next").alias("next"))
        near = labels.join(least, ["field", "rep"]).select("field", "rep", F.col("label").alias("old"), F.least("label", "next").alias("label"))
        jump = labels.select("field", F.col("rep").alias("label"), F.col("label").alias("far"))
        new = cut_lineage(near.join(jump, ["field", "label"], "left").select("field", "rep", "old", F.coalesce(F.least("label", "far"), F.col("label")).alias("label")))
        if new.filter("label <> old").isEmpty():
            break
        labels = new.select("field", "rep", "label")
    n = links.groupBy("field", F.col("a").alias("rep")).agg(F.count("*").alias("links"))
    out = membership.join(labels, ["field", "rep"], "left").join(n, ["field", "rep"], "left")
    return out.select("field", "id", F.coalesce("label", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
