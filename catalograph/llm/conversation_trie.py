"""Trie of conversation prefixes, with a count-min screen in front of the exact grouping.

A node is a distinct sequence of first turns. Turns are hashed where they are read; texts never move. The hashes
of a conversation's turns, ordered, are run together into a digest of each of its prefixes (four polynomials modulo
2^31 - 1, 124 bits), chunk by chunk of at most ``CHUNK`` turns, so no row or task holds a conversation that is large.

A count-min sketch of all prefix digests follows: each task sends the cells it met, block by block, and counters stop at
two. An estimate of one proves that a prefix belongs to one conversation only; then so do all longer ones, and the
whole tail is emitted where it is read. Only prefixes with an estimate above one are shuffled and grouped
exactly. The sketch has ``LINES`` lines of at most ``MOST_CELLS`` cells; beyond that its estimates rise, more prefixes
are grouped exactly and the result stays the same.

Sums over subtrees need no walk by levels. A node belongs to the smallest conversation that passes it, so each
conversation owns the lower end of its path. Its owned values, summed from below (in blocks of depths), are what it
adds to each node of its path, and a node's sum is a plain grouping over the conversations that pass it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.tables import written
from catalograph.operators.lists import numbered

PRIME = (1 << 31) - 1
BASES = np.array([1482907613, 1029384757, 762939453, 2011847291], np.int64)
CHUNK = 1024
BLOCK = 1 << 16           # cells of a block of the sketch
LINES = 3
MOST_CELLS = 1 << 26      # of a line: three lines are then 25 MB of bits
_TALLIED = 1 << 20        # digests a task counts before it sends cells
HEAVY = 1000              # a parent with more than this part of all children is looked up by broadcast
_MULTIPLIERS = np.array([[0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], [0xD6E8FEB86659FD93, 0x94D049BB133111EB],
                         [0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD]], np.uint64)
NODE = ["a", "b", "depth"]


# ---------------------------------------------------------------- turns

def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """``(conv, place, k1, k2, words)``: the turns of each conversation in order of ``turn``, null first, from 0.

    Equal turn numbers are ordered by a hash of role and text, repeated rows stay repeated turns. A null role or
    text counts as empty; rows without a conversation take no part. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), role, text).alias("k2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return written(numbered(rows, ["conv"], ["turn", "k1", "k2"]).select("conv", F.col("_n").alias("place"), "k1", "k2", "words"),
                   "turns")


def borrowed_heads(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Turns of rebuilt conversations: the first h turns of conversation c - c % every, then c's own after its first h.

    h is the unsigned crc32 of c in decimal, modulo ``most``. A shorter or absent first conversation gives what it
    has; ``place`` ascends but may have gaps. The remainder of a negative c has its sign.
    """
    own = F.crc32(F.col("conv").cast("string")) % most
    heads = turns.where((F.col("conv") % every == 0) & (F.col("place") < most - 1)).withColumnRenamed("conv", "base")
    borrowed = (turns.where("place = 0").select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), own.alias("h"))
                .where("h > 0").join(heads, "base").where("place < h").select("conv", "place", "k1", "k2", "words"))
    return borrowed.unionByName(turns.where(F.col("place") >= own).withColumn("place", F.col("place") + most))


# ---------------------------------------------------------------- prefix digests

_CHUNKS = ("part int, seq long, conv long, first boolean, last boolean, start long, pa long, pb long, "
           "a array<long>, b array<long>, words array<long>")


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _pack(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return lanes[0] << 31 | lanes[1], lanes[2] << 31 | lanes[3]


def _unpack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([a >> 31, a & PRIME, b >> 31, b & PRIME])


def _power(base: int, exponent: int) -> int:
    return pow(int(base), int(exponent), PRIME)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (part, conv, place, k1, k2, words) to chunks of prefix digests.

    Within a part a conversation's rows count from 0; what earlier parts hold of the part's first conversation is
    added when the chunks are read (``_Carry``). ``last`` says whether the conversation ends with the chunk, null if
    the part does.
    """
    names = [field.split(" ")[0] for field in _CHUNKS.split(", ")]
    at, count, lanes, powers = None, 0, np.zeros(4, np.int64), np.ones(4, np.int64)
    first_conv, seq, waiting = None, 0, None
    table = np.ones((4, 1), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        conv = batch.column("conv").to_numpy()
        size = len(conv)
        while table.shape[1] <= size:
            step = np.array([[_power(base, table.shape[1])] for base in BASES])
            table = np.concatenate((table, table * step % PRIME), 1)
        starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        sizes = np.diff(np.append(starts, size))
        relative = np.arange(size) - np.repeat(starts, sizes)
        goes_on = at is not None and conv[0] == at
        if first_conv is None:
            first_conv = conv[0]
        if waiting is not None:
            yield waiting(bool(conv[0] != at))
        head = int(sizes[0])
        keys = [batch.column(k).to_numpy().view(np.uint64) for k in ("k1", "k2")]
        words = np.stack([part_ for k in keys for part_ in ((k >> np.uint64(33)).astype(np.int64) % PRIME,
                                                            (k & np.uint64(PRIME)).astype(np.int64) % PRIME)])
        terms = words * table[:, relative] % PRIME
        if goes_on:
            terms[:, :head] = terms[:, :head] * powers[:, None] % PRIME
        sums = np.cumsum(terms, 1)
        before = np.concatenate((np.zeros((4, 1), np.int64), sums[:, :-1]), 1)
        base = np.repeat(before[:, starts], sizes, 1)
        sums, before = sums - base, before - base
        if goes_on:
            sums[:, :head] += lanes[:, None]
            before[:, :head] += lanes[:, None]
        sums, before = sums % PRIME, before % PRIME
        depth = relative + np.where(np.arange(size) < head, count if goes_on else 0, 0)
        begin = np.flatnonzero(relative % CHUNK == 0)
        ends = np.append(begin, size)
        (a, b), (pa_, pb_) = _pack(sums), _pack(before[:, begin])
        columns = [pa.array(np.full(len(begin), part, np.int32)), pa.array(seq + np.arange(len(begin))), pa.array(conv[begin]),
                   pa.array(conv[begin] == first_conv), None, pa.array(depth[begin]), pa.array(pa_), pa.array(pb_),
                   _lists(a, ends), _lists(b, ends), _lists(batch.column("words").to_numpy(), ends)]
        seq += len(begin)
        last = np.append(conv[begin][1:] != conv[begin][:-1], False)

        def finish(final, columns=columns, last=last):
            flags = pa.array([*last[:-1].tolist(), final], pa.bool_())
            return pa.RecordBatch.from_arrays([*columns[:4], flags, *columns[5:]], names)

        waiting = finish
        tail = int(sizes[-1])
        whole = goes_on and len(starts) == 1
        count = (count if whole else 0) + tail
        powers = np.array([_power(base, count) for base in BASES])
        lanes, at = sums[:, -1].copy(), conv[-1]
    if waiting is not None:
        yield waiting(None)


class _Carry:
    """What earlier parts hold of each part's first conversation: one entry a part, however large the data."""

    def __init__(self, chunks: DataFrame):
        final = F.struct((F.col("start") + F.size("a")).alias("n"), F.get("a", F.size("a") - 1).alias("a"),
                         F.get("b", F.size("b") - 1).alias("b"))
        parts = chunks.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"),
                                           F.max_by(final, "seq").alias("end"), F.sum(F.size("a")).alias("rows")).collect()
        self.of: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        self.going_on: set[int] = set()
        self.rows = sum(p.rows for p in parts)
        before, conv, count, lanes = None, None, 0, np.zeros(4, np.int64)
        for p in sorted(parts, key=lambda p: p.part):
            own = _unpack(np.array(p.end.a), np.array(p.end.b))
            carried = conv is not None and p.first == conv
            if carried:
                powers = np.array([_power(base, count) for base in BASES])
                self.of[p.part] = (count, lanes, powers)
                self.going_on.add(before)
            if carried and p.last == p.first:
                count, lanes = count + p.end.n, (lanes + powers * own) % PRIME
            else:
                conv, count, lanes = p.last, p.end.n, own
            before = p.part

    def flat(self, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        """Chunks with what earlier parts hold, and their prefixes flat: chunk, conv, depth, a, b, pa, pb, words, last."""
        sizes = np.diff(batch.column("a").offsets.to_numpy())
        a, b, words = (batch.column(c).flatten().to_numpy().copy() for c in ("a", "b", "words"))
        chunk = np.repeat(np.arange(batch.num_rows), sizes)
        begin = np.cumsum(sizes) - sizes
        start, pa_, pb_ = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("start", "pa", "pb"))
        part = batch.column("part").to_numpy()
        known = batch.column("last").to_pylist()
        last = np.array([p not in self.going_on if x is None else x for x, p in zip(known, part.tolist())], bool)
        first = batch.column("first").to_numpy(zero_copy_only=False)
        for n in np.flatnonzero(first).tolist():
            if part[n] in self.of:
                count, lanes, powers = self.of[part[n]]
                start[n] += count
                own = slice(begin[n], begin[n] + sizes[n])
                a[own], b[own] = _pack((lanes[:, None] + powers[:, None] * _unpack(a[own], b[own])) % PRIME)
                pa_[n], pb_[n] = _pack((lanes + powers * _unpack(pa_[n], pb_[n])) % PRIME)
        before_a, before_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
        before_a[begin], before_b[begin] = pa_, pb_
        place = np.arange(len(a)) - begin[chunk]
        return {"chunk": chunk, "begin": begin, "conv": batch.column("conv").to_numpy()[chunk], "depth": start[chunk] + place,
                "a": a, "b": b, "pa": before_a, "pb": before_b, "words": words,
                "last": last[chunk] & (place == sizes[chunk] - 1)}


def _chunks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Written chunks of all conversations; each begins with the empty prefix, at depth 0."""
    zero = F.lit(0).cast("long")
    rows = convs.select("conv", F.lit(-1).cast("long").alias("place"), zero.alias("k1"), zero.alias("k2"), zero.alias("words"))
    rows = rows.unionByName(turns).repartitionByRange("conv", "place").sortWithinPartitions("conv", "place")
    return written(rows.select(F.spark_partition_id().alias("part"), *rows.columns).mapInArrow(_run, _CHUNKS), "prefixes")


# ---------------------------------------------------------------- the sketch

def _cells(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Cell of each digest in each line, numbered through all lines."""
    mixed = a.view(np.uint64)[None] * _MULTIPLIERS[:, :1] + b.view(np.uint64)[None] * _MULTIPLIERS[:, 1:]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    cells = (mixed >> np.uint64(64 - (width.bit_length() - 1))).astype(np.int64)
    return cells + np.arange(LINES)[:, None] * width


def sketch_width(prefixes: int) -> int:
    """Cells of a line: four a prefix, a power of two, between one block and ``MOST_CELLS``."""
    return min(MOST_CELLS, max(BLOCK, 1 << (4 * prefixes).bit_length()))


def _sketch(chunks: DataFrame, carry: _Carry, width: int) -> np.ndarray:
    """A bit a cell: whether its count-min counter is above one."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            flat = carry.flat(batch)
            held.append(_cells(flat["a"], flat["b"], width).ravel())
            size += len(flat["a"])
            if size > _TALLIED:
                yield sent(held)
                held, size = [], 0
        if held:
            yield sent(held)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        block = cells // BLOCK
        begin = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        spans = list(zip(begin.tolist(), [*begin[1:].tolist(), len(cells)]))
        places, again = (cells % BLOCK).astype("<u2"), counts > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(block[begin]), pa.array([places[i:j].tobytes() for i, j in spans], pa.binary()),
             pa.array([places[i:j][again[i:j]].tobytes() for i, j in spans], pa.binary())], ["block", "met", "again"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counters = None, np.zeros(BLOCK, np.uint8)  # counters stop at two
        for batch in batches:
            for now, met, again in zip(*(c.to_pylist() for c in batch.columns)):
                if block is not None and now != block:
                    yield packed(block, counters)
                    counters[:] = 0
                block = now
                places = np.frombuffer(met, "<u2")
                counters[places] = np.minimum(counters[places] + 1, 2)
                counters[np.frombuffer(again, "<u2")] = 2
        if block is not None:
            yield packed(block, counters)

    def packed(block: int, counters: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([np.packbits(counters > 1).tobytes()], pa.binary())], ["block", "bits"])

    blocks = (chunks.mapInArrow(tally, "block long, met binary, again binary").repartition("block").sortWithinPartitions("block")
              .mapInArrow(merged, "block long, bits binary"))
    bits = np.zeros((LINES * width // BLOCK, BLOCK // 8), np.uint8)
    for row in blocks.toLocalIterator():
        bits[row.block] = np.frombuffer(row.bits, np.uint8)
    return bits.ravel()


def _screened(chunks: DataFrame, carry: _Carry, width: int, bits: np.ndarray) -> DataFrame:
    """Prefixes as rows (kind, conv, depth, a, b, pa, pb, words, last), written.

    ``shared`` may belong to several conversations. The others are proved to belong to one: ``head`` follows a prefix
    that may be shared, ``tail`` follows a proved one or is the empty prefix of the only conversation.
    """
    spread = chunks.sparkSession.sparkContext.broadcast(bits)

    def single(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        cells = _cells(a, b, width)
        return ~(spread.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool).all(0)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            flat = carry.flat(batch)
            number, chunk = np.arange(len(flat["a"])), flat["chunk"]
            proved = np.minimum.reduceat(np.where(single(flat["a"], flat["b"]), number, len(number)), flat["begin"])[chunk]
            kind = np.where(number < proved, 0, np.where(number == proved, 1, 2))
            opens = (number == flat["begin"][chunk]) & (kind == 1)  # what comes before lies in another chunk
            kind[opens & ((flat["depth"] == 0) | single(flat["pa"], flat["pb"]))] = 2
            root = flat["depth"] == 0
            arrays = [pa.array(np.array(["shared", "head", "tail"])[kind]), *(pa.array(flat[c]) for c in ("conv", "depth", "a", "b")),
                      *(pa.array(flat[c], mask=root) for c in ("pa", "pb")), pa.array(flat["words"]), pa.array(flat["last"])]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "conv", "depth", "a", "b", "pa", "pb", "words", "last"])

    return written(chunks.mapInArrow(split, "kind string, conv long, depth long, a long, b long, pa long, pb long, "
                                            "words long, last boolean"), "screened")


# ---------------------------------------------------------------- the trie

def _nodes(shared: DataFrame, heads: DataFrame) -> DataFrame:
    """Exact nodes of the prefixes that may be shared, with the number of their children."""
    nodes = shared.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("words").alias("words"),
                                      F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    parent = [F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth")]
    children = (nodes.where("depth > 0").select(*parent).unionAll(heads.select(*parent))
                .groupBy(*NODE).agg(F.count("*").alias("n_children")))
    return written(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")


def _subtree_sums(shared: DataFrame, nodes: DataFrame, proved: DataFrame) -> DataFrame:
    """Per node ``n_leaves`` and ``saved_tokens`` of its subtree."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    values = nodes.select("conv", "depth", none.alias("a"), none.alias("b"), (F.col("n_children") == 0).cast("long").alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    values = values.unionAll(proved.where("last").select("conv", "depth", none, none, F.lit(1).cast("long"), zero))
    path = shared.select("conv", "depth", "a", "b", zero.alias("leaf"), zero.alias("saved")).unionAll(values)
    path = path.withColumn("block", F.floor(F.col("depth") / CHUNK))
    here = Window.partitionBy("conv", "block").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    below = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = path.groupBy("conv", "block").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    blocks = blocks.select("conv", "block", F.sum("leaf").over(below).alias("more_leaf"), F.sum("saved").over(below).alias("more_saved"))
    summed = path.select("conv", "block", *NODE, F.sum("leaf").over(here).alias("leaf"), F.sum("saved").over(here).alias("saved"))
    summed = summed.where("a IS NOT NULL").join(blocks.where("more_leaf > 0 OR more_saved > 0"), ["conv", "block"], "left")
    return summed.groupBy(*NODE).agg(F.sum(F.col("leaf") + F.coalesce("more_leaf", zero)).alias("n_leaves"),
                                     F.sum(F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"))


def _ends(shared: DataFrame) -> DataFrame:
    """Per node the SHA-256 of the ids of the conversations that end there, ascending, joined by commas.

    The ids of one node may be many: ranges of (node, id) make pieces of text, and one task hashes the pieces of a
    node one after the other, holding one at a time.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in NODE])
            conv = batch.column("conv").to_numpy()
            new = np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(0)))
            begin = np.flatnonzero(new)
            texts = [",".join(map(str, conv[i:j].tolist())) for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(conv)])]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[begin]) for k in key), pa.array(conv[begin]), pa.array(texts)], [*NODE, "conv", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = now, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*NODE, "ends"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, state.hexdigest())], [*NODE, "ends"])

    rows = shared.where("last").select(*NODE, "conv")
    texts = (rows.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
             .mapInArrow(pieces, "a long, b long, depth long, conv long, ids string"))
    return (texts.repartition(*NODE).sortWithinPartitions(*NODE, "conv")
            .mapInArrow(hashed, "a long, b long, depth long, ends string"))


def _with_parents(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv``, the smallest conversation of the node at (pa, pb, depth - 1), null where there is none.

    Fewer than ``HEAVY`` nodes can have more than that part of all children; these are broadcast, so the children of a
    prefix that begins a third of all conversations are not sent to one task.
    """
    total = nodes.agg(F.sum("n_children")).first()[0] or 0
    named = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv").alias("parent_conv"), (F.col("n_children") * HEAVY > total).alias("heavy"))
    on = ["pa", "pb", "depth"]
    found = children.join(F.broadcast(named.where("heavy").drop("heavy")), on, "left")
    rest = found.where("parent_conv IS NULL").drop("parent_conv").join(named.where("NOT heavy").drop("heavy"), on, "left")
    return found.where("parent_conv IS NOT NULL").unionByName(rest)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per node of the trie of all conversations.

    ``convs(conv)`` lists each conversation once, with or without turns, and ``turns(conv, place, k1, k2, words)`` holds
    their turns, ``place`` from 0 on and unique in its conversation. Returns ``conv`` (smallest member), ``depth``,
    ``parent_conv`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``, as the query's contract words them. No conversations give no rows, not even a root.
    """
    chunks = _chunks(convs, turns)
    carry = _Carry(chunks)
    width = sketch_width(carry.rows)
    screened = _screened(chunks, carry, width, _sketch(chunks, carry, width))
    shared, heads, proved = (screened.where(w) for w in ("kind = 'shared'", "kind = 'head'", "kind <> 'shared'"))
    nodes = _nodes(shared, heads)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    known = nodes.join(_subtree_sums(shared, nodes, proved), NODE).join(_ends(shared), NODE, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    fields = ["conv", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    own = [F.col("conv"), F.col("depth"), one.alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"),
           one.alias("n_leaves"), zero.alias("saved_tokens"), F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).alias("ends")]
    looked_up = _with_parents(known.select("pa", "pb", *fields).unionByName(heads.select("pa", "pb", *own)), nodes)
    above = screened.where("kind = 'tail'").select(*own, F.lit(None).cast("long").alias("parent_conv"))
    return looked_up.select(*fields, "parent_conv").unionByName(above).select(
        "conv", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv", "conv")).alias("parent_conv"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))
