"""N-gram Jaccard join by vertical partitioning.

Every text becomes the set of its distinct 5-word shingles, each a 64-bit
hash; the hash order is the global n-gram order.  For a class of set sizes
the order is cut into F fragments, and a set into its segments.  Two sets of
sizes a, b with Jaccard likeness t or more differ in at most
(a + b)(1 - t)/(1 + t) n-grams; F is larger than that for every size of the
class, so some segment is equal in both: equal segments name the candidates,
and no frequent n-gram alone does.  A set whose non-empty segments are too few
for this argument also gives the first n-grams of its order (prefix filter).
Candidates are counted exactly: the sets that occur in a candidate pair are cut
into fragments again, the partial overlap of each fragment is counted on its own,
and the counts are summed per pair.

Texts with equal sets are one node (id: 128 bits of the set), so copies
never meet each other.  For the components alone, within a candidate group only a star around the set
that shares most segments is counted first; pairs of the group that are then
in one component need no count, all others are counted then.  For the links every candidate pair is counted.  Sets in one map batch that share a
segment with many others are attached to one leader before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (binary_array, binary_parts, durable, mix, mix_int, not_space, row_chunks,
                     shuffle_width, word_hashes)
from .components import components

N_WORDS, THRESHOLD = 5, 80          # shingle width; likeness in hundredths
VERIFY_FRAGMENTS = 4                # fragments in which candidate overlaps are counted
RARE = 8                            # sets that share an n-gram at most for it to name pairs by itself
LEADER_FROM = 8                     # sets of one batch that share a segment before a leader stands for them
CHUNK_BYTES = 1 << 20            # text worked on at once
FLUSH_SIGNATURES = 1 << 19       # signatures that a map task holds before it deals them out
MEMBER_BYTES = 4 << 20           # payload that a reduce task unpacks at once
_COEFF = np.array([mix_int(1001 + j) | 1 for j in range(64)], dtype=np.uint64)


def size_classes(largest: int, threshold: int) -> list[tuple[int, int, int]]:
    """(lowest size, highest size, most differences of a linked pair) per class, up to ``largest`` and one beyond."""
    out, lo = [], 1
    while True:
        hi = max(lo, lo * 8 // 5)
        out.append((lo, hi, 2 * hi * (100 - threshold) // (100 + threshold)))
        if lo > largest:
            return out
        lo = hi + 1


def shingle_sets(data, offsets, n_words: int = N_WORDS):
    """Per text the sorted distinct shingle hashes (uint64)."""
    words, first = word_hashes(data, offsets, not_space())
    total = len(words)
    grams = np.zeros(max(0, total - n_words + 1), np.uint64)
    for j in range(n_words):
        grams += words[j:j + len(grams)] * _COEFF[j]
    grams = mix(grams)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= n_words:
            s = np.sort(grams[lo:hi - n_words + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif hi > lo:  # fewer words: the whole sequence is one shingle
            yield mix((words[lo:hi] * _COEFF[:hi - lo]).sum(dtype=np.uint64, keepdims=True) + np.uint64(hi - lo))
        else:
            yield np.empty(0, np.uint64)


def set_id(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    a = mix(np.array([s.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))
    b = mix(s + _COEFF[63]).sum(dtype=np.uint64, keepdims=True)
    return a.tobytes() + b.tobytes()


def _sets(batches, n_words):
    for batch in batches:
        off, data = binary_parts(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for lo, hi in row_chunks(off, CHUNK_BYTES):
            yield list(zip(ids[lo:hi], shingle_sets(data, off[lo:hi + 1], n_words)))


def _describe(n_words):
    def run(batches):
        for batch in batches:
            off, data = binary_parts(batch.column("text"))
            for lo, hi in row_chunks(off, CHUNK_BYTES):
                sets = [(len(s), set_id(s)) for s in shingle_sets(data, off[lo:hi + 1], n_words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("text_key").slice(lo, hi - lo),
                     pa.array([n for n, _ in sets], pa.int64()), binary_array([x for _, x in sets])],
                    names=["doc_id", "text_key", "n_shingles", "sid"])
    return run


def segment_signatures(s: np.ndarray, threshold: int) -> list[tuple[int, int, np.ndarray]]:
    """(class, need, signatures) for every size class that the set takes part in.

    Signatures stand for the non-empty segments.  ``need``: so many segments at least
    are equal to those of any linked set of the class.  Where the argument leaves no
    segment (few non-empty ones), the first n-grams of the order are signatures too and need is 0.
    """
    n, out = len(s), []
    mixed = mix(s)
    for c, (lo, hi, differ) in enumerate(size_classes(n, threshold)):
        if hi < n or n * 100 < lo * threshold or not differ:
            continue  # without a permitted difference only equal sets are linked
        pieces = differ + 3 + differ // 10
        at = ((s >> np.uint64(32)) * np.uint64(pieces)) >> np.uint64(32)
        starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        tag = np.uint64(mix_int(7 * c + 1))
        sigs = mix(np.add.reduceat(mixed, starts) + at[starts] * _COEFF[60] + tag)
        need = len(starts) - (n + min(hi, n * 100 // threshold)) * (100 - threshold) // (100 + threshold)
        if need <= 0:
            sigs, need = np.concatenate((sigs, mix(s[:n - -(-threshold * n // 100) + 1] ^ tag))), 0
        out.append((c, need, sigs))
    return out


_HEAD = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("cls", "<u1"), ("need", "<u4"), ("count", "<u4")])
_ENTRY = np.dtype([("sig", "<u8"), ("hi", "<u8"), ("lo", "<u8"), ("cls", "u1"), ("need", "<u4"), ("led", "u1")])


def _pack(sig, owner, heads, led) -> bytes:
    """One payload: heads of the sets with the number of signatures of each, the signatures, leader marks."""
    sets, counts = np.unique(owner, return_counts=True)
    head = heads[sets]
    head["count"] = counts
    return b"".join((np.array([len(sets), len(sig)], "<u4").tobytes(), head.tobytes(), sig.tobytes(), led.astype("u1").tobytes()))


def _unpack(raw, piece: int = 0, pieces: int = 1) -> np.ndarray:
    """The signatures of a payload whose upper half falls in ``piece`` of ``pieces`` even ranges, each with its set."""
    n, m = (int(x) for x in np.frombuffer(raw, "<u4", 2))
    head = np.frombuffer(raw, _HEAD, n, 8)
    at = 8 + n * _HEAD.itemsize
    sig, led = np.frombuffer(raw, "<u8", m, at), np.frombuffer(raw, "u1", m, at + 8 * m)
    mine = np.flatnonzero(((sig >> np.uint64(32)) * np.uint64(pieces)) >> np.uint64(32) == np.uint64(piece))
    owner = head[np.repeat(np.arange(n, dtype=np.uint32), head["count"])[mine]]
    out = np.empty(len(mine), _ENTRY)
    out["sig"], out["led"] = sig[mine], led[mine]
    for k in ("hi", "lo", "cls", "need"):
        out[k] = owner[k]
    return out


def _runs(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1)) if len(x) else np.empty(0, np.int64)


def _emit(buckets: int, threshold: int, n_words: int):
    """Map side: payloads of signatures by bucket; sets that a leader of the batch stands for go to any bucket, marked."""
    def flush(heads, sigs, turn):
        head = np.array(heads, _HEAD)
        owner = np.repeat(np.arange(len(sigs)), [len(x) for x in sigs])
        sig = np.concatenate(sigs)
        order = np.lexsort((owner, sig))
        sig, owner = sig[order], owner[order]
        starts = _runs(sig)
        counts = np.diff(np.append(starts, len(sig)))
        many = np.repeat(counts >= LEADER_FROM, counts)
        led = np.zeros(len(sig), bool)
        led[starts[counts >= LEADER_FROM]] = True
        where = (sig % np.uint64(buckets)).astype(np.int64)
        out = []
        by = np.flatnonzero(~many | led)
        by = by[np.lexsort((owner[by], where[by]))]
        for part in np.split(by, np.flatnonzero(np.diff(where[by])) + 1):
            out.append((int(where[part[0]]), False, _pack(sig[part], owner[part], head, led[part])))
        rest = np.flatnonzero(many & ~led)
        if len(rest):
            rest = rest[np.argsort(owner[rest], kind="stable")]
            out.append(((int(sig[rest[0]]) + turn) % buckets, True, _pack(sig[rest], owner[rest], head, led[rest])))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.bool_()),
             binary_array([x[2] for x in out])], names=["bucket", "attached", "payload"])

    def run(batches):
        turn, seen, heads, sigs, held = 0, set(), [], [], 0
        for rows in _sets(batches, n_words):
            for _, s in rows:
                key = set_id(s)
                if not len(s) or key in seen:  # equal sets of the batch are one
                    continue
                seen.add(key)
                hi, lo = (int(x) for x in np.frombuffer(key, "<u8"))
                for c, need, x in segment_signatures(s, threshold):
                    heads.append((hi, lo, c, need, 0))
                    sigs.append(x)
                    held += len(x)
            if held > FLUSH_SIGNATURES:
                yield flush(heads, sigs, turn)
                turn, seen, heads, sigs, held = turn + 1, set(), [], [], 0
        if held:
            yield flush(heads, sigs, turn)
    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: (gid, cls, sid, need, weight) of signatures that two sets share.

    The bucket stays packed and is unpacked by ranges of signatures, each of about ``MEMBER_BYTES``.  Groups of equal members are
    one within a range; the caller sums the weights of those of several ranges and buckets.
    """
    packed = [(p.as_buffer(), a.as_py()) for batch in batches for p, a in zip(batch.column("payload"), batch.column("attached"))]
    pieces = 1 + sum(raw.size for raw, _ in packed) // MEMBER_BYTES
    for piece in range(pieces):
        yield _shared([_unpack(raw, piece, pieces) for raw, attached in packed if not attached],
                      [_unpack(raw, piece, pieces) for raw, attached in packed if attached])


def _shared(plain: list[np.ndarray], found: list[np.ndarray]) -> pa.RecordBatch:
    """Members of the signatures that two sets share; ``found``: sets that a leader stands for, members in any case."""
    gids, weights = [x["sig"] for x in found], [np.ones(len(x), np.int32) for x in found]
    if plain:
        e = np.concatenate(plain)
        plain.clear()
        e = e[np.argsort(e["sig"], kind="stable")]
        sizes = np.diff(np.append(_runs(e["sig"]), len(e)))
        led = np.maximum.reduceat(e["led"], _runs(e["sig"])) > 0 if len(e) else np.empty(0, bool)
        e = e[np.repeat((sizes > 1) | led, sizes)]
        if len(e):
            starts = _runs(e["sig"])
            sizes = np.diff(np.append(starts, len(e)))
            led = np.maximum.reduceat(e["led"], starts) > 0
            members = np.add.reduceat(mix(e["hi"] ^ mix(e["lo"] + e["cls"])), starts)
            name = np.where(led, e["sig"][starts], mix(members + sizes.astype(np.uint64)))
            _, first, back, weight = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
            kept = np.zeros(len(starts), bool)
            kept[first] = True
            keep = np.repeat(kept, sizes)
            gids.append(np.repeat(name, sizes)[keep])
            weights.append(np.repeat(weight[back], sizes)[keep].astype(np.int32))
            found.append(e[keep])
    e = np.concatenate(found) if found else np.empty(0, _ENTRY)
    gid = np.concatenate(gids) if gids else np.empty(0, np.uint64)
    flat = np.ascontiguousarray(np.stack((e["hi"], e["lo"]), axis=1)).astype("<u8")
    ends = np.arange(0, 16 * len(gid) + 1, 16, dtype=np.int32)
    sid = pa.Array.from_buffers(pa.binary(), len(gid), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())])
    return pa.RecordBatch.from_pydict({"gid": pa.array(gid.view(np.int64)), "cls": pa.array(e["cls"].astype(np.int32)), "sid": sid,
                                       "need": pa.array(e["need"].astype(np.int32)),
                                       "weight": pa.array(np.concatenate(weights) if weights else np.empty(0, np.int32))})


def possible_members(members: DataFrame) -> DataFrame:
    """Drop memberships that no linked pair depends on.

    A set that shares fewer segments than ``need`` has no link.  Of the others, each keeps its rarest
    memberships but ``need - 1`` of them: two linked sets share ``need`` or more, so they still meet (prefix
    filter over segments, order: group size, group).  Groups of one set go.
    """
    key = Window.partitionBy("sid", "cls")
    for _ in range(2):
        have = members.withColumn("have", F.sum("weight").over(key)).where("have >= need").drop("have")
        size = have.groupBy("gid").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        members = durable(have.join(size, "gid").drop("size"))
    size = members.groupBy("gid").agg(F.count(F.lit(1)).alias("size"))
    ranked = (members.join(size, "gid").withColumn("have", F.sum("weight").over(key))
              .withColumn("before", F.sum("weight").over(key.orderBy("size", "gid").rowsBetween(Window.unboundedPreceding, -1))))
    kept = ranked.where("have >= need and coalesce(before, 0) < have - greatest(need, 1) + 1").select("gid", "sid", "have")
    size = kept.groupBy("gid").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return kept.join(size, "gid").select("gid", "sid", "have")


def _segments(n_words):
    """Sets of the wanted texts, cut into fragments of the global order."""
    def run(batches):
        for batch in batches:
            off, data = binary_parts(batch.column("text"))
            want = batch.column("sid").to_pylist()
            for lo, hi in row_chunks(off, CHUNK_BYTES):
                sid, frag, grams = [], [], []
                for key, s in zip(want[lo:hi], shingle_sets(data, off[lo:hi + 1], n_words)):
                    if set_id(s) != key:
                        continue  # another text under a repeated doc_id
                    cuts = np.searchsorted(s, (np.arange(1, VERIFY_FRAGMENTS, dtype=np.uint64) << np.uint64(62)))
                    for f, part in enumerate(np.split(s.view(np.int64), cuts)):
                        sid.append(key)
                        frag.append(f)
                        grams.append(part)
                if sid:
                    flat = np.concatenate(grams)
                    offs = np.concatenate(([0], np.cumsum([len(g) for g in grams]))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [binary_array(sid), pa.array(frag, pa.int32()),
                         pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, pa.int64()))], names=["sid", "frag", "grams"])
    return run


def _segment_table(ids: DataFrame, docs: DataFrame, sets: DataFrame, n_words: int) -> DataFrame:
    """(sid, frag, grams) of the sets named in ``ids`` (sid)."""
    texts = docs.join(sets.join(ids.distinct(), "sid").select("sid", "doc_id"), "doc_id").select("sid", "text")
    return durable(texts.mapInArrow(_segments(n_words), "sid binary, frag int, grams array<bigint>").dropDuplicates(["sid", "frag"]))


def _count_links(pairs: DataFrame, seg: DataFrame, threshold: int) -> DataFrame:
    """Of the pairs (a, b) those that reach the threshold, by partial overlaps summed over the fragments."""
    left = pairs.join(seg.withColumnsRenamed({"sid": "b", "grams": "gb"}), "b")
    both = left.join(seg.withColumnsRenamed({"sid": "a", "grams": "ga"}), ["a", "frag"])
    counted = (both.select("a", "b", F.size("ga").alias("na"), F.size("gb").alias("nb"),
                           F.size(F.array_intersect("ga", "gb")).alias("part"))
               .groupBy("a", "b").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"), F.sum("part").alias("both")))
    return counted.where(100 * F.col("both") >= threshold * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _rare_grams(seg: DataFrame) -> DataFrame:
    """(gram, sid, sets) of the n-grams that at most ``RARE`` sets of ``seg`` have."""
    at = seg.select("sid", F.explode("grams").alias("gram"))
    few = at.groupBy("gram").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") <= RARE)
    return at.join(few, "gram")


def _bounds(seg: DataFrame, rare: DataFrame) -> DataFrame:
    """(sid, n, shared, common): size of each set, its n-grams that another set of ``seg`` has, and those that more than ``RARE`` have."""
    size = seg.groupBy("sid").agg(F.sum(F.size("grams")).alias("n"))
    few = rare.groupBy("sid").agg(F.count(F.lit(1)).alias("rare"), F.count_if(F.col("sets") == 1).alias("own"))
    return size.join(few, "sid", "left").select("sid", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"),
                                                (F.col("n") - F.coalesce("rare", F.lit(0))).alias("common"))


def _apart(members: DataFrame) -> DataFrame:
    """Members of the groups that still hold two components."""
    split = members.groupBy("gid").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l != h").select("gid")
    return members.join(split, "gid")


def _can_link(threshold: int):
    return (100 + threshold) * F.least("x_shared", "y_shared") >= threshold * (F.col("x_n") + F.col("y_n"))


def _reachable(members: DataFrame, threshold: int) -> DataFrame:
    """Members that some set of their group may be linked with, by the bound; groups of one set go."""
    low = members.groupBy("gid").agg(F.min("n").alias("least"))
    near = members.join(low, "gid").where((100 + threshold) * F.col("shared") >= threshold * (F.col("n") + F.col("least"))).drop("least")
    size = near.groupBy("gid").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("gid")
    return near.join(size, "gid")


def _sides(members: DataFrame, key: str):
    return [members.select(key, *[F.col(c).alias(side + c) for c in ("sid", "label", "n", "shared")]) for side in ("x_", "y_")]


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x_sid", "y_sid").alias("a"), F.greatest("x_sid", "y_sid").alias("b")).distinct()


def _candidates(docs: DataFrame, threshold: int, n_words: int):
    """(facts of the documents, sets, segments of the candidate sets, their rare n-grams, memberships that a link may depend on)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    facts = durable(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(_describe(n_words), "doc_id bigint, text_key bigint, n_shingles bigint, sid binary"))
    sets = facts.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))
    buckets = shuffle_width(spark)
    payloads = docs.mapInArrow(_emit(buckets, threshold, n_words), "bucket int, attached boolean, payload binary")
    members = durable(payloads.groupBy("bucket").applyInArrow(_members, "gid bigint, cls int, sid binary, need int, weight int")
                      .groupBy("gid", "cls", "sid", "need").agg(F.sum("weight").alias("weight")))
    members = durable(possible_members(members))
    seg = _segment_table(members.select("sid"), docs, sets, n_words)
    # Two sets have no more n-grams in common than either shares with any set that is left, which bounds their
    # likeness: sets and pairs that cannot reach the threshold go before any pair is counted.
    rare = _rare_grams(seg)
    bounds = durable(_bounds(seg, rare))
    sized = members.join(bounds, "sid")
    sized = durable(_reachable(sized, threshold))
    return facts, sets, seg, rare, sized


def _met_pairs(apart: DataFrame, rare: DataFrame, threshold: int) -> DataFrame:
    """Pairs of members with different labels that may be linked.

    Pairs without a rare n-gram in common have only common ones to share, a bound that few pass.  The other pairs meet
    on their rare n-grams, of which each names a bounded number of pairs.
    """
    frequent = _reachable(apart.withColumn("shared", F.col("common")), threshold)
    x, y = _sides(frequent, "gid")
    met = _pairs(x.join(y, (x.gid == y.gid) & (F.col("x_label") < F.col("y_label")) & _can_link(threshold)))
    left = apart.select("sid", "label", "n", "shared").distinct()
    x, y = _sides(rare.where("sets > 1").select("gram", "sid").join(left, "sid"), "gram")
    few = _pairs(x.join(y, (x.gram == y.gram) & (F.col("x_label") < F.col("y_label")) & _can_link(threshold)))
    return met.unionByName(few).distinct()


def _places(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(sid, component_id, n_copies, label) of every set; the label names its component."""
    named = sets.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "label").select("sid", "component_id", "n_copies", "label")


def jaccard_components(docs: DataFrame, threshold: int = THRESHOLD, n_words: int = N_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies, text_key, label) for documents (doc_id, text, ...).

    component_id is the smallest doc_id that links reach; n_copies counts
    the documents with the same shingle set.  text_key, Spark's xxhash64 of the text, tells rows with a repeated doc_id apart;
    label names the component itself (null: linked with nothing), as components may share their smallest doc_id where ids repeat.  Null or empty text: n_shingles 0, linked
    with nothing.  Rows with a repeated doc_id are rows of their own and all
    returned; rows with a null doc_id are returned with their component's smallest
    known doc_id.  Very long texts are one row each and never cut.  An empty table gives no rows.  Other
    columns are ignored, whatever their names.
    """
    facts, sets, seg, rare, sized = _candidates(docs, threshold, n_words)
    # a star around the set of each group that shares most segments with others
    lead = sized.groupBy("gid").agg(F.max(F.struct("have", "sid", "n", "shared")).alias("x")).select(
        "gid", *[F.col("x." + c).alias("x_" + c) for c in ("sid", "n", "shared")])
    met = sized.select("gid", *[F.col(c).alias("y_" + c) for c in ("sid", "n", "shared")]).join(lead, "gid")
    tried = durable(_pairs(met.where((F.col("x_sid") != F.col("y_sid")) & _can_link(threshold))))
    links = durable(_count_links(tried, seg, threshold))
    labels = durable(components(links))
    # pairs of a group that are not in one component yet
    named = sized.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    apart = durable(_reachable(_apart(named), threshold))
    if not apart.isEmpty():
        rest = durable(_met_pairs(apart, rare, threshold).join(tried, ["a", "b"], "left_anti"))
        more = durable(_count_links(rest, seg, threshold))
        if not more.isEmpty():
            labels = durable(components(links.unionByName(more)))
    return (facts.join(_places(sets, labels), "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), "text_key", "label"))


def jaccard_links(docs: DataFrame, threshold: int = THRESHOLD, n_words: int = N_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): as ``jaccard_components``, with the number of other rows that each row is linked with.

    Every candidate pair of different sets is counted, also within a component; a link between two sets stands for
    one between each two of their copies, and copies are linked with each other.  The cost grows with the number of links.
    """
    facts, sets, seg, rare, sized = _candidates(docs, threshold, n_words)
    pairs = durable(_met_pairs(sized.withColumn("label", F.col("sid")), rare, threshold))
    links = durable(_count_links(pairs, seg, threshold))
    both = links.select(F.col("a").alias("sid"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("sid"), F.col("a").alias("other")))
    others = (both.join(sets.select(F.col("sid").alias("other"), "n_copies"), "other")
              .groupBy("sid").agg(F.sum("n_copies").alias("linked")))
    places = _places(sets, components(links)).join(others, "sid", "left")
    return (facts.join(places, "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    (F.coalesce("n_copies", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links")))
