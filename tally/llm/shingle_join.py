"""Texts whose word shingles overlap by 80 % or more, by prefix filters under several global orders of the shingles.

Two sets of Jaccard similarity t or more share a shingle among the first n - ceil(t n) + 1 of each, under any order of
all shingles that is the same for all texts. One order makes the candidates: rare shingles first, as far as one pass
over all texts counts them, so that a passage that many texts share stands at the end. Each further order (by another
hash) is a second opinion: a candidate must share a shingle of that order's prefixes, too. What is left is verified.

Before the sets of a pair are brought together, a small count of each set's shingles by class of hash bounds what the
two can share, which leaves few pairs that fail.

A group of thousands of near copies has millions of pairs, and they are not emitted. Texts that share a prefix shingle
are first held against one of them, the one with the fewest shingles of its own, from which copies differ least. Links
found this way join texts into components. Texts that are not in that one's component are held against the next such
text, round by round; only texts that are then still in different components under one shingle are paired. Nothing is
lost: a pair is left out only if its texts are in one component already, or if the place of their first common shingle
says that they can't overlap enough.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import balanced, byte_slices, texts_of
from tally.llm.components import components
from tally.llm.scratch import files_for, session_scratch, written
from tally.llm.words import Words, mixed
from tally.sources.scratch import Scratch

WIDTH = 5
PERCENT = 80
ORDERS = 3
ROUNDS = 2  # of texts held against one, before what is left is paired
# shingles of the largest frequencies whose order is by frequency; a bound on what is broadcast (8 bytes each). It is
# no cap on candidates: the order of any others is by hash, and every order finds every link
FREQUENT = 1 << 20
LEAST_FREQUENT = 16
CLASSES = 128  # of hashes, counted in a sketch of each set
BITS = 1 << 27  # of the table that says which shingles stand in two texts or more; false hits cost time only

_U64 = np.uint64


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of each text in ascending order, text i's at first[i]:first[i + 1].

    A text with fewer words than ``width`` has its whole sequence as one shingle, one without words none.
    """
    hashes, at = words.windows(width)
    text = np.searchsorted(words.first, at, side="right") - 1
    few = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(few):
        whole = []
        for i in few.tolist():
            h = _U64(words.counts[i])
            for x in words.hashes[words.first[i] : words.first[i + 1]]:
                h = mixed(np.array([h ^ x]))[0]
            whole.append(h)
        hashes, text = np.concatenate([hashes, np.array(whole, _U64)]), np.concatenate([text, few])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(words.counts) + 1))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U64(64 - 27)).astype(np.int64)


def _count_shingles(docs: DataFrame, parts: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(frequent, several) over all texts of ``docs`` (text): the shingles of the largest document frequencies, most
    frequent last, and a bit for each hash prefix that holds a shingle of two texts or more.

    Each task sends its shingles as sorted 40-bit numbers, one row per range of hashes; a frequency under such a number
    is that of all shingles which share it, which is as good for an order.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 4 << 20):
            pieces = [shingles(Words.of(texts_of(part), lower=True))[0] >> _U64(24) for part in byte_slices([batch], "text")]
            keys, counts = np.unique(np.concatenate(pieces), return_counts=True)
            edges = np.searchsorted(keys, (np.arange(parts + 1, dtype=np.float64) * (2.0**40 / parts)).astype(_U64))
            blobs, many = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                # the steps between sorted numbers as planes of bytes, whose upper ones compress
                steps = np.diff(keys[a:b], prepend=_U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                blobs.append(np.ascontiguousarray(steps.T).tobytes())
                twice = np.flatnonzero(counts[a:b] > 1).astype("<u4")
                many.append(twice.tobytes() + counts[a:b][twice].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), pa.array(blobs, pa.binary()), pa.array(many, pa.binary())], ["part", "keys", "many"])

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for blob, many in zip(table["keys"].to_pylist(), table["many"].to_pylist(), strict=True):
            planes = np.frombuffer(blob, np.uint8).reshape(5, -1).T
            wide = np.zeros((len(planes), 8), np.uint8)
            wide[:, :5] = planes
            keys.append(np.cumsum(wide.view("<u8").ravel(), dtype=_U64))
            n = np.ones(len(planes), np.int64)
            twice = np.frombuffer(many, "<u4").reshape(2, -1)
            n[twice[0]] = twice[1]
            counts.append(n)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        keys, counts = keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts
        slots = np.unique((keys[counts > 1] >> _U64(13)).astype(np.int64))
        often = np.flatnonzero(counts >= LEAST_FREQUENT)
        often = often[np.argsort(-counts[often], kind="stable")[:FREQUENT]]
        return pa.table(
            {
                "slots": pa.array([slots.astype("<i4").tobytes()], pa.binary()),
                "keys": pa.array([keys[often].astype("<u8").tobytes()], pa.binary()),
                "counts": pa.array([counts[often].astype("<i8").tobytes()], pa.binary()),
            }
        )

    sent = docs.select(F.col("text")).mapInArrow(send, "part int, keys binary, many binary")
    merged = sent.groupBy("part").applyInArrow(merge, "slots binary, keys binary, counts binary")
    # what comes to the driver is bounded by BITS and, a part, by FREQUENT; it is merged row by row
    merged = written(merged, "counted-shingles", scratch)
    several = np.zeros(BITS // 8, np.uint8)
    keys, counts = np.empty(0, _U64), np.empty(0, np.int64)
    for row in merged.toLocalIterator():
        slots = np.frombuffer(row["slots"], "<i4")
        np.bitwise_or.at(several, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
        keys = np.concatenate([keys, np.frombuffer(row["keys"], "<u8")])
        counts = np.concatenate([counts, np.frombuffer(row["counts"], "<i8")])
        if len(keys) > FREQUENT:
            top = np.lexsort((keys, -counts))[:FREQUENT]
            keys, counts = keys[top], counts[top]
    scratch.drop(merged)
    return keys[np.lexsort((keys, counts))], several


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """n - ceil(percent n / 100) + 1, at most n."""
    return np.minimum(n - (percent * n + 99) // 100 + 1, n)


class _Orders:
    """Places of shingles in the global orders."""

    def __init__(self, frequent: np.ndarray):
        self.sorted = np.sort(frequent)
        self.rank = np.argsort(frequent).astype(_U64)  # place by frequency of the i-th smallest number

    def places(self, hashes: np.ndarray, order: int) -> np.ndarray:
        """Shingles that are not frequent come first, by a hash of their own for each order; then the frequent ones.
        An order may be asked for hashes, or for their upper 40 bits alone, if all sets are given alike."""
        place = mixed(hashes + _U64(order * 0x9E3779B97F4A7C15 % 2**64)) >> _U64(1)
        if len(self.sorted):
            key = hashes >> _U64(24)
            i = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
            often = self.sorted[i] == key
            place[often] = (_U64(1) << _U64(63)) | (self.rank[i[often]] << _U64(24)) | (hashes[often] & _U64(0xFFFFFF))
        return place

    def prefixes(self, hashes: np.ndarray, first: np.ndarray, order: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, text, place in the text's order) of the prefixes under an order."""
        n = np.diff(first)
        text = np.repeat(np.arange(len(n)), n)
        by = np.lexsort((self.places(hashes, order), text))
        at = np.arange(len(hashes)) - first[text]
        keep = at < _prefix(n, percent)[text]
        return hashes[by][keep], text[keep], at[keep]


def _postings(docs: DataFrame, frequent: np.ndarray, several: np.ndarray, percent: int, width: int) -> DataFrame:
    """(shingle, id, n, f1, f2, sketch): one row per text without a shingle, with its set's size, fingerprint and sketch,
    and one row per shingle of its prefix under the first order that may stand in another text, where f1 is the
    shingle's place in the text's order, and f2 is small for texts with few shingles of their own (the rest of it is a
    hash of the set). A task sends the shingles of texts with the same set once."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, several))  # FREQUENT numbers and BITS bits at most

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, several = shared.value
        orders, met = _Orders(frequent), set()
        for part in byte_slices(batches):
            hashes, first = shingles(Words.of(texts_of(part), lower=True), width)
            n = np.diff(first)
            sums = [np.concatenate([np.zeros(1, _U64), np.cumsum(mixed(hashes ^ _U64(salt)), dtype=_U64)]) for salt in (1, 2)]
            f1, f2 = (mixed(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)
            fresh = np.zeros(len(n), bool)
            for i, key in enumerate(zip(n.tolist(), f1.tolist(), strict=True)):
                if key[0] and key not in met:
                    fresh[i] = True
                    if len(met) < 1_000_000:
                        met.add(key)
            places = np.repeat(np.arange(len(n)), n) * CLASSES + (hashes >> _U64(57)).astype(np.int64)
            counts = np.minimum(np.bincount(places, minlength=len(n) * CLASSES), 255).astype(np.uint8).reshape(-1, CLASSES)
            ids = part.column("id")
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), pa.int64()), ids, pa.array(n, pa.int64()), pa.array(f1), pa.array(f2), pa.array([c.tobytes() for c in counts], pa.binary())], names
            )
            token, text, place = orders.prefixes(hashes, first, 0, percent)
            slot = _slot(token)
            other = ((several[slot >> 3] >> (slot & 7)) & 1).astype(bool)
            own = 1 - np.bincount(text[other], minlength=len(n)) / np.maximum(_prefix(n, percent), 1)
            lead = (np.rint(own * 10_000).astype(np.int64) << 48) | (f1.view(_U64) >> _U64(16)).astype(np.int64)
            keep = fresh[text] & other
            token, text, place = token[keep].view(np.int64), text[keep], place[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), ids.take(pa.array(text)), pa.array(n[text], pa.int64()), pa.array(place, pa.int64()), pa.array(lead[text]), pa.nulls(len(token), pa.binary())], names
            )

    names = ["shingle", "id", "n", "f1", "f2", "sketch"]
    longs = [T.StructField(c, T.LongType()) for c in names[2:5]]
    schema = T.StructType([T.StructField("shingle", T.LongType()), docs.schema["id"], *longs, T.StructField("sketch", T.BinaryType())])
    return docs.mapInArrow(post, schema)


def _possible(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave room for the overlap: the classes' counts differ by no more than the sets may."""

    def sketches(batch: pa.RecordBatch, column: str) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(column).to_pylist()), np.uint8).reshape(-1, CLASSES).astype(np.int32)

    def possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            room = total - 2 * (-(-percent * total // (100 + percent)))
            apart = np.abs(sketches(batch, "left") - sketches(batch, "right")).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(apart <= room))

    left = texts.select(F.col("id").alias("a"), "n", F.col("sketch").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").where("n > 0 and m > 0").select("a", "b", "n", "m", "left", "right")
    return joined.mapInArrow(possible, pairs.schema).distinct()


def _packed(hashes: np.ndarray) -> bytes:
    return np.unique(hashes >> _U64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    """The numbers at the upper end of 64 bits, where the orders look for them."""
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, 3:] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel().astype(_U64)


def _place(ids, bits: int, salt: int = 0):
    """The place from 1 to ``bits`` of an id in a bit table."""
    return F.pmod(F.xxhash64(ids, F.lit(salt)), F.lit(bits)) + 1


def _bit_tables(ids: DataFrame, bits: int, sides: int, salt: int = 0) -> list[np.ndarray]:
    """``sides`` tables of ``bits`` bits, the i-th with the places set of all ids of ``ids`` (id, side) whose side is i."""
    place = _place(F.col("id"), bits, salt)
    maps = ids.groupBy("side", F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    size = 32768 // 8
    flat = [np.zeros(bits // 8, np.uint8) for _ in range(sides)]
    for row in maps.coalesce(8).toLocalIterator():  # one row of 4 KB for each 32768 bits; a partition is a job
        flat[row["side"]][(row["k"] - 1) * size : row["k"] * size] = np.frombuffer(row["bits"], np.uint8)
    return flat


def _set_at(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (flat[at >> 3] >> (at & 7) & 1).astype(bool)


def _sets_of(docs: DataFrame, pairs: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(id, set, is_a, is_b): the shingles of the texts of ``pairs`` (a, b) and of few others, as packed 40-bit numbers in
    ascending order, and whether the id stands on either side; in a pair of sets of thousands, less than one in 10 ** 5
    pairs holds two shingles that share one, and such a pair is told wrongly only if a single shingle decides. Bit tables
    of fixed size over hashes of the ids keep the rest from being sent; they let a few ids through that stand nowhere."""
    bits = 1 << 26
    spark = docs.sparkSession
    ends = pairs.select(F.expr("inline(array(struct(a as id, 0 as side), struct(b as id, 1 as side)))"))
    shared = spark.sparkContext.broadcast(_bit_tables(ends, bits, 2))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            is_a, is_b = (_set_at(flat, at) for flat in shared.value)
            marked = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(is_a), pa.array(is_b)], ["id", "text", "is_a", "is_b"])
            for part in byte_slices([marked.filter(pa.array(is_a | is_b))]):
                hashes, first = shingles(Words.of(texts_of(part), lower=True), width)
                sets = pa.array([_packed(hashes[a:b]) for a, b in zip(first, first[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), sets, part.column("is_a"), part.column("is_b")], ["id", "set", "is_a", "is_b"])

    schema = T.StructType([docs.schema["id"], T.StructField("set", T.BinaryType()), *(T.StructField(c, T.BooleanType()) for c in ("is_a", "is_b"))])
    sets = written(docs.select("id", "text", (_place(F.col("id"), bits) - 1).alias("at")).mapInArrow(pack, schema), "sets", scratch)
    shared.destroy()
    return sets


def _verified(
    pairs: DataFrame, texts: DataFrame, docs: DataFrame, frequent: np.ndarray, percent: int, width: int, orders: int, scratch: Scratch, files: int | None = None
) -> DataFrame:
    """The pairs (a, b) that the sketches and the other orders' prefixes let through and whose sets overlap enough."""
    pairs = written(_possible(pairs, texts, percent), "candidates", scratch, files)
    if pairs.isEmpty():
        return pairs
    sets = _sets_of(docs, pairs, width, scratch)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = _Orders(shared.value)
        last: dict[bytes, tuple] = {}

        def prefixes(raw: bytes) -> tuple:
            if raw not in last:
                if len(last) > 64:
                    last.clear()
                x = _unpacked(raw)
                n = np.array([0, len(x)])
                last[raw] = x, [np.sort(ranked.prefixes(x, n, k, percent)[0]) for k in range(1, orders)]
            return last[raw]

        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                (x, px), (y, py) = prefixes(batch.column("left")[i].as_py()), prefixes(batch.column("right")[i].as_py())
                if all(len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(px, py, strict=True)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    # of the texts held against one, the one's set is sent for all of them once; a side gets the sets that stand there
    left = sets.where("is_a").select(F.col("id").alias("a"), F.col("set").alias("left"))
    right = sets.where("is_b").select(F.col("id").alias("b"), F.col("set").alias("right"))
    joined = pairs.join(right, "b").join(left, "a")
    links = written(joined.select("a", "b", "left", "right").mapInArrow(verify, pairs.schema).distinct(), "links", scratch, files)
    scratch.drop(pairs, sets)
    shared.destroy()
    return links


def _shared(posts: DataFrame) -> DataFrame:
    """The posts, with ``first`` as in ``_led``, of one shingle for each group of two texts or more: of all shingles under
    which just these texts stand, that which comes first in the order. The others would make the same pairs at later
    places. Groups are told apart by their size, leader and two sums of 32-bit hashes."""
    post = F.xxhash64("id", "n", "lead")
    sums = F.sum(post.bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned(post, 32)).alias("high")
    facts = posts.groupBy("shingle").agg(F.count("*").alias("texts"), F.min("lead").alias("first"), F.sum("at").alias("place"), *sums)
    chosen = facts.where("texts > 1").groupBy("texts", "first", "low", "high").agg(F.min_by("shingle", "place").alias("shingle"))
    return posts.join(chosen.select("shingle", "first"), "shingle")


def _led(posts: DataFrame) -> DataFrame:
    """The posts of shingles that stand in two texts or more, with ``first``, the smallest ``lead`` under each."""
    facts = posts.groupBy("shingle").agg(F.count("*").alias("texts"), F.min("lead").alias("first"))
    return posts.join(facts.where("texts > 1").select("shingle", "first"), "shingle")


def _stars(held: DataFrame, fit) -> DataFrame:
    """Distinct (a, b): each text b under a shingle (see ``_led``) with the text a that leads there, unless one component
    holds both."""
    classed = "c" in held.columns
    named = held.where("lead = first").groupBy("first").agg(F.min("id").alias("a"), F.min("n").alias("m"), *([F.min("c").alias("d")] if classed else []))
    others = held.where("lead <> first").select("first", "id", "n", *(["c"] if classed else [])).distinct()
    pairs = others.join(named, "first").where((F.col("id") != F.col("a")) & fit("n", "m"))
    if classed:
        pairs = pairs.where("c <> d")
    return pairs.select("a", F.col("id").alias("b")).distinct()


def _classed(posts: DataFrame, found: DataFrame) -> DataFrame:
    """The posts, with their component ``c``, of shingles whose texts are in several components."""
    classes = found.withColumnRenamed("node", "id").withColumnRenamed("component", "c")
    placed = posts.join(classes, "id", "left").withColumn("c", F.coalesce("c", "id"))
    facts = placed.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    return placed.join(facts.select("shingle"), "shingle", "left_semi")


def _without_leaders(posts: DataFrame) -> DataFrame:
    """Of such posts those outside of the leading text's component, for the next round's leader. (The pairs in the end
    are made from all of them.)"""
    leaders = posts.groupBy("shingle").agg(F.min(F.struct("lead", "c")).alias("first")).select("shingle", F.col("first.c").alias("lead_class"))
    return posts.join(leaders, "shingle").where("c <> lead_class").drop("lead_class")


def shingle_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, width: int = WIDTH, orders: int = ORDERS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Two texts link when 100 * |intersection| >= percent * |union| of their sets of distinct ``width``-word shingles
    (A to Z lowered). Null, empty and blank texts have no shingles and link with nothing. Rows that repeat an id
    are one node: it links with whatever any of its texts links with. Ids must be integers; rows with a null id keep a null component. An empty table gives an empty one;
    further columns are left behind. Very long texts are read whole. What the result reads lies in ``scratch`` (the
    session's own, if not given), what only a round needed is deleted behind it.
    """
    scratch = scratch or session_scratch(docs.sparkSession)
    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    known = narrow.where(F.col("id").isNotNull())
    parts = max(32, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    frequent, several = _count_shingles(known, parts, scratch)
    posted = written(_postings(known, frequent, several, percent, width), "postings", scratch)

    texts = written(posted.where("shingle is null").select("id", "n", "f1", "f2", "sketch"), "texts", scratch)
    files = files_for(docs.sparkSession, texts.count())  # of all tables of ids and posts; what texts are read for is dealt by bytes
    same = written(texts.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "equal-sets", scratch, files)  # equal sets link
    copies = texts.join(same, ["n", "f1", "f2"]).where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    copies = written(copies, "copies", scratch, files)
    scratch.drop(same)

    def fit(x: str, y: str):
        return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)

    posts = posted.where("shingle is not null").select("shingle", "id", "n", F.col("f1").alias("at"), F.col("f2").alias("lead"))
    open_posts = written(_shared(posts), "shared-shingles", scratch, files)
    scratch.drop(posted)
    tried, found, known_links = None, None, copies
    for turn in range(ROUNDS):
        held = _led(written(_without_leaders(open_posts), "without-leaders", scratch, files)) if turn else open_posts
        pairs = written(_stars(held, fit), "stars", scratch, files)
        tried = pairs if tried is None else tried.unionAll(pairs)
        more = _verified(pairs, texts, known, frequent, percent, width, orders, scratch, files)
        # the components so far stand for all links so far
        grown = written(components(known_links.unionAll(more), scratch=scratch, files=files), "components", scratch, files)
        scratch.drop(known_links if found is None else found, more)
        found, known_links = grown, grown.select(F.col("component").alias("a"), F.col("node").alias("b"))
        # components only grow, so a shingle that is in one component stays there
        still = written(_classed(open_posts.drop("c", "first"), found), "open-posts", scratch, files)
        scratch.drop(open_posts)
        open_posts = still

    # what is still in different components under one shingle, pair by pair
    far = (F.least(F.col("n") - F.col("at"), F.col("m") - F.col("bt")) * (100 + percent)) >= (F.col("n") + F.col("m")) * percent
    other = open_posts.select("shingle", F.col("id").alias("b"), F.col("n").alias("m"), F.col("c").alias("d"), F.col("at").alias("bt"))
    pairs = open_posts.withColumnRenamed("id", "a").join(other, "shingle").where((F.col("a") < F.col("b")) & (F.col("c") != F.col("d")) & fit("n", "m") & far)
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.select("a", "b").distinct().join(done, ["a", "b"], "left_anti")
    more = _verified(pairs, texts, known, frequent, percent, width, orders, scratch, files)
    scratch.drop(open_posts)

    merged = found if more.isEmpty() else components(known_links.unionAll(more), scratch=scratch, files=files)
    out = texts.select("id", "n").join(merged.withColumnRenamed("node", "id"), "id", "left").coalesce(files)
    classed = out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    unknown = narrow.where(F.col("id").isNull())
    lost = _postings(unknown, frequent[:0], several, percent, width).where("shingle is null")
    return classed.unionAll(lost.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def _held(tables: list, bits: int, ids, salt: int = 0):
    """Whether an id is in the first of broadcast bit tables, and not there just for being wrong, as the next ones tell."""

    def held(places: pa.Array) -> pa.Array:
        at = places.flatten().to_numpy().reshape(-1, len(tables))
        out = np.zeros(len(at), bool)
        for i in reversed(range(len(tables))):
            out = _set_at(tables[i].value, at[:, i]) & ~out
        return pa.array(out)

    return F.arrow_udf(held, "boolean")(F.array(*[_place(ids, bits, salt + i) - 1 for i in range(len(tables))]))


def _without(docs: DataFrame, id_column: str, gone: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``gone`` (id), told by bit tables where the rows lie.

    The first table holds the ids of ``gone``, the next one those of other rows that the first one lets pass as well, the
    next those of ``gone`` that this one holds, too, and so on until a table holds no wrong id; only ids are shuffled for
    it. Where ``gone`` would fill a quarter of a table, the rows are joined instead.
    """
    plain = docs.join(gone.withColumnRenamed("id", "__id"), docs[id_column] == F.col("__id"), "left_anti")
    if (leaving := gone.count()) * 4 > bits:
        return plain
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        tables, inside, outside = [], gone, docs.select(F.col(id_column).alias("id")).where("id is not null")
        while True:
            salt = len(tables)
            tables.append(spark.sparkContext.broadcast(_bit_tables(inside.select("id", F.lit(0).alias("side")), bits, 1, salt)[0]))
            wrong = outside.where(_held(tables[-1:], bits, F.col("id"), salt))
            wrong = written(wrong if salt else wrong.join(gone, "id", "left_anti"), "wrong-ids", scratch, files_for(spark, leaving))
            if wrong.isEmpty():
                break
            inside, outside = wrong, inside

    ids = F.coalesce(F.col(id_column), F.lit(0))
    return docs.where(F.col(id_column).isNull() | ~_held(tables, bits, ids))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, width: int = WIDTH, orders: int = ORDERS) -> DataFrame:
    """The rows of ``docs`` with all their columns, of each component the one with the smallest id.

    Rows alike in id and text are one document; texts without shingles (null, empty and blank ones) and rows without an
    id all stay. Texts are read whole, however long; an empty table gives an empty one.
    """
    with Scratch(docs.sparkSession) as scratch:  # all but the classes goes once they are written
        found = shingle_components(docs, id_column, text_column, percent, width, orders, scratch)
        found = written(found.select(F.col(id_column).alias("__id"), "n_shingles", "component_id"), "classes")
    others = found.where("component_id <> __id").select(F.col("__id").alias("id"))
    again = found.where("n_shingles > 0 and __id is not null").groupBy("__id").count().where("count > 1").select("__id")
    again = written(again, "repeated-ids")
    kept = _without(docs, id_column, others)
    if again.isEmpty():
        return kept
    once = kept.join(again, kept[id_column] == again["__id"], "left_semi").dropDuplicates([id_column, text_column])
    return kept.join(again, kept[id_column] == again["__id"], "left_anti").unionAll(once)
