"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius.

Every word votes with a weight that grows with its length, every pair of neighbouring words with weight one. A
term has a hash of 128 bits of its own (two 64-bit mixes) and votes for each bit's value; a bit of the fingerprint
is 1 where the votes sum to more than zero. Weights are counted by the value of each hash byte, which gives
the sums of the bits at the end. Counts add up, so a text of any length is read in parts.

Fingerprints within radius r of each other agree on the key of at least one table. Up to radius 3 a key is one of
r + 1 blocks of bits. Above that the bits are dealt to groups that tolerate 2 differing bits each (7 blocks, a
key for each line of the Fano plane, the 4 blocks off the line: the line through the blocks that differ is spared), and
one that tolerates the rest; not every group can exceed what it tolerates, as that takes r + 1 bits. Pairs of a
table share a key; a pair counts in the first table that finds it only. Only distinct fingerprints enter the
tables, and a list of one key gives counts, one row per member, not pairs. Keys with more than ``block`` members, as
estimated from a share of the fingerprints, are dealt as pairs of blocks to several tasks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import cut_at_space, join_classes, text_slices, written

BITS, BYTES = 128, 16
ROWS = BYTES * 256  # one for each value of each hash byte
RADIUS = 3   # near_counts by itself: copies and all but copies
EDITED = 13  # lightly edited texts: holds 9 of 10 texts of sf0.1 with three words replaced
MOST = 20    # above that keys have too few bits to part unrelated texts
BLOCK = 4096
_PART = 1 << 20  # characters whose votes are counted at a time
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))

_fixed: dict[str, np.ndarray] = {}


def _signs() -> np.ndarray:
    """Votes of each value of each hash byte, (ROWS, BITS); a byte votes for its own 8 bits only."""
    if "signs" not in _fixed:
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1
        _fixed["signs"] = np.kron(np.eye(BYTES), bits)
    return _fixed["signs"]


def _is_word() -> np.ndarray:
    if "word" not in _fixed:
        _fixed["word"] = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _fixed["word"]


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_fixed.get("power", ())) < length:
        size = max(1 << 16, 1 << (length - 1).bit_length())
        for name, base in (("power", _PRIME), ("inverse", _INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _fixed[name] = np.multiply.accumulate(out)
    return _fixed["power"][:length], _fixed["inverse"][:length]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _votes(parts: list[str], owner: list[int], rows: np.ndarray) -> None:
    """Add the signed weights of all terms of ``parts`` to the rows of their owners."""
    lowered = [p.lower() for p in parts]
    sizes = np.fromiter((len(p) + 1 for p in lowered), np.int64, len(lowered))
    codes = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], _is_word()[codes], [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return
    powers, inverses = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * powers[:len(codes)], out=sums[1:])
    word = _mixed((sums[ends] - sums[starts]) * inverses[starts])
    part = np.searchsorted(np.cumsum(sizes), starts, side="right")
    whose = np.asarray(owner)[part]
    together = part[1:] == part[:-1]
    pair = _mixed(word[:-1] * np.uint64(3) + (word[1:] ^ np.uint64(0x5851F42D4C957F2D)))[together]
    for term, at, weight in ((word, whose, np.minimum(ends - starts, 10) * 0.05), (pair, whose[:-1][together], None)):
        values = rows.reshape(len(rows), BYTES, 256)
        for number, half in enumerate((term, _mixed(term + _PRIME))):
            for byte in range(8):
                cell = at * 256 + (half >> np.uint64(56 - 8 * byte) & np.uint64(255)).astype(np.int64)
                values[:, 8 * number + byte] += np.bincount(cell, weight, len(rows) * 256).reshape(-1, 256)


def fingerprints(texts: list[str]) -> np.ndarray:
    """Fingerprints as (texts, 16) bytes, first bit first. A text without a word has all bits 0."""
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    for at in range(0, len(texts), 64):
        some = texts[at:at + 64]
        rows = np.zeros((len(some), ROWS))
        parts, owner, size = [], [], 0
        for number, text in enumerate(some):
            for part in cut_at_space(text, _PART):
                parts.append(part)
                owner.append(number)
                size += len(part)
                if size >= _PART:
                    _votes(parts, owner, rows)
                    parts, owner, size = [], [], 0
        if parts:
            _votes(parts, owner, rows)
        # weights are multiples of 1/20: whole numbers add up exactly, so the sums do not depend on the order
        votes = np.rint(rows * 20).reshape(len(some), BYTES, 256) @ _signs()[:256, :8]
        out[at:at + 64] = np.packbits(votes.reshape(len(some), BITS) > 0.5, axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of each pair of fingerprints, 0 to 1."""
    return 1 - np.unpackbits(a ^ b, axis=1).sum(1) / BITS


def _longs(prints: np.ndarray) -> tuple[pa.Array, pa.Array]:
    words = np.ascontiguousarray(prints).view(">u8").astype(np.uint64).view(np.int64)
    return pa.array(words[:, 0]), pa.array(words[:, 1])


def hex_of(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def fingerprint_column(text: Column) -> Column:
    """Struct (high, low) of two longs for a text column; a null text counts as empty."""

    @F.arrow_udf("high long, low long")
    def of(column: pa.Array) -> pa.Array:
        parts = [fingerprints(texts) for texts in text_slices(column, 1 << 20)]
        high, low = _longs(np.concatenate(parts) if parts else np.zeros((0, BITS // 8), np.uint8))
        return pa.StructArray.from_arrays([high, low], ["high", "low"])

    return of(text)


# ---------------------------------------------------------------- texts and their edited forms

def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_EDITED = ("id long, n_chars long, edited_sha256 string, high long, low long, edited_high long, edited_low long, "
           "near_edited double, near_next double")


def _compared(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
    """``rows`` of (id, text) and the text after each."""
    texts = [t for _, t in rows]
    changed = [edited(t, f) for t, f in zip(texts, following)]
    # the text after a row is mostly the next row's
    own, other = fingerprints(texts), fingerprints(changed)
    after = np.concatenate((own[1:], fingerprints(following[-1:])))
    for k in range(len(rows) - 1):
        if following[k] is not texts[k + 1]:
            after[k] = fingerprints([following[k]])[0]
    digests = [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed]
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(digests),
         *_longs(own), *_longs(other), pa.array(likeness(own, other)), pa.array(likeness(own, after))],
        [part.split()[0] for part in _EDITED.split(", ")])


_READ = f"{_EDITED}, part int, ends string, text string"


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, id, text) of a range in order: each needs the text after it. The first and the last row of the range
    come as they are too, marked in ``ends``, as what follows the last one lies in another range."""
    rows: list[tuple] = []
    after: list[str] = []
    size, last, part = 0, None, None

    def compared() -> pa.RecordBatch:
        batch = _compared(rows, after)
        none = [pa.nulls(len(rows), kind) for kind in (pa.int32(), pa.string(), pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns, *none], [c.split()[0] for c in _READ.split(", ")])

    def end(which: str, row: tuple) -> pa.RecordBatch:
        values = [row[0], *[None] * (len(_EDITED.split(", ")) - 1), part, which, row[1]]
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in _READ.split(", ")])

    for batch in batches:
        for number, text in zip(batch.column("id"), batch.column("text")):
            row = (number.as_py(), text.as_py() or "")
            if last is None:
                part = batch.column("part")[0].as_py()
                yield end("first", row)
            else:
                rows.append(last)
                after.append(row[1])
                size += len(last[1])
                if size > _PART:
                    yield compared()
                    rows, after, size = [], [], 0
            last = row
    if rows:
        yield compared()
    if last is not None:
        yield end("last", last)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, following), one at a time."""
    for batch in batches:
        for number, text, following in zip(*(batch.column(c) for c in ("id", "text", "following"))):
            yield _compared([(number.as_py(), text.as_py())], [following.as_py()])


def compare_edited(docs: DataFrame, task_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_chars``, the edited text's digest, both fingerprints as two longs
    each, ``near_edited`` and ``near_next``.

    The next document is the one after it by id, after the last the first; null ids come first, rows of one id are
    in the order of their text's hash, by which a large group of one id is spread too. A null text is empty. Texts move once, to
    ranges of (id, hash) that Spark cuts; of each range the first and the last text are kept beside the narrow results and
    meet afterwards, whatever the number of ranges. Other columns are not read; an empty table gives no row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.coalesce(F.col("id"), F.lit(-(1 << 63)))
    rows = rows.select("id", "text", key.alias("key"), F.xxhash64("text").alias("hash"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    if not total["n"]:
        return spark.createDataFrame([], _EDITED)
    tasks = max(1, min(total["n"], -(-(total["bytes"] or 0) // task_bytes)))
    ordered = (rows.repartitionByRange(tasks, "key", "hash").sortWithinPartitions("key", "hash")
               .select(F.spark_partition_id().alias("part"), "id", "text"))
    read = written(ordered.mapInArrow(_in_order, _READ), "ordered")
    # the numbers of the ranges that hold rows, one a task
    parts = [r.part for r in read.where("ends = 'first'").select("part").orderBy("part").collect()]
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = read.where("ends = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    lasts = read.where("ends = 'last'").select("part", "id", "text").join(follows, "part").join(firsts, "next")
    joined = lasts.select("id", "text", "following").mapInArrow(_pairs, _EDITED)
    return read.where("ends IS NULL").select(*joined.columns).unionByName(joined)


# ---------------------------------------------------------------- permuted block tables

_LINES = ((0, 1, 2), (0, 3, 4), (0, 5, 6), (1, 3, 5), (1, 4, 6), (2, 3, 6), (2, 4, 5))  # any two points are on one


def key_masks(radius: int) -> list[tuple[int, int]]:
    """Bits of the two words that are the key of each table, so that a pair within ``radius`` shares a key."""
    if radius < 4:
        groups = [(1, [{0}])] * (radius + 1)  # blocks, and the blocks of each key
    else:
        off = [set(range(7)) - set(line) for line in _LINES]
        rest = {0: [], 1: [(1, [{0}])], 2: [(3, [{0, 1}, {0, 2}, {1, 2}])]}
        groups = [(7, off)] * ((radius + 1) // 3) + rest[(radius + 1) % 3]
    # keys of about one length in all groups
    weights = [blocks / len(keys[0]) for blocks, keys in groups]
    edges = np.rint(np.cumsum([0, *weights]) / sum(weights) * BITS).astype(int).tolist()
    out = []
    for (blocks, keys), start, end in zip(groups, edges, edges[1:]):
        inner = np.rint(np.linspace(start, end, blocks + 1)).astype(int).tolist()
        for key in keys:
            mask = sum(1 << (BITS - 1 - bit) for block in key for bit in range(inner[block], inner[block + 1]))
            out.append((mask >> 64, mask & (1 << 64) - 1))
    return out


def _near(radius: int):
    masks = np.array(key_masks(radius), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, (None,)):
            if batch is None:
                if held is None:
                    return
                rows, last = held, True
            else:
                now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
                rows, last = (now if held is None else np.concatenate((held, now), axis=1)), False
            if not rows.shape[1]:
                continue
            starts = np.concatenate(([0], np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(0)) + 1))
            if not last:
                held, rows, starts = rows[:, starts[-1]:], rows[:, :starts[-1]], starts[:-1]
            found = _counts(rows, np.diff(np.append(starts, rows.shape[1])), masks, radius)
            some = found > 0
            yield pa.RecordBatch.from_arrays([pa.array(rows[3][some]), pa.array(rows[4][some]), pa.array(found[some])],
                                             ["high", "low", "near"])

    return run


def _counts(rows: np.ndarray, sizes: np.ndarray, masks: np.ndarray, radius: int) -> np.ndarray:
    """Rows list, blocks, second, high, low, n of groups of so many rows. Documents near each row, found first here."""
    table, dealt, second = rows[0] >> 32, rows[1] > 0, rows[2]
    high, low, n = rows[3].view(np.uint64), rows[4].view(np.uint64), rows[5]
    out = np.zeros(rows.shape[1], np.int64)
    after = np.repeat(np.cumsum(sizes), sizes) - np.arange(rows.shape[1]) - 1  # rows of the group after each
    first, apart = np.arange(rows.shape[1]), 0
    while True:  # each row with the one so far after it, for all groups at once
        apart += 1
        first = first[after[first] >= apart]
        if not len(first):
            return out
        other = first + apart
        x, y = high[first] ^ high[other], low[first] ^ low[other]
        near = np.flatnonzero(np.bitwise_count(x) + np.bitwise_count(y) <= radius)
        if not len(near):
            continue
        a, b, x, y = first[near], other[near], x[near], y[near]
        # of a pair of blocks the pairs across them, of one block all its pairs; lists of one hash may mix keys
        own = masks[table[a]]
        good = (~dealt[a] | (second[a] != second[b])) & ((x & own[:, 0] | y & own[:, 1]) == 0)
        for earlier, (left, right) in enumerate(masks):
            good &= (table[a] <= earlier) | ((x & left | y & right) != 0)
        a, b = a[good], b[good]
        out[a] += n[b]
        out[b] += n[a]


def near_counts(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(high, low, n, near)`` per distinct fingerprint of ``prints(high, low)``: rows that have it, and rows with
    another fingerprint at ``radius`` or fewer differing bits. No pair within the radius is missed. Rows without a
    fingerprint take no part."""
    if not 0 <= radius <= MOST:
        raise ValueError(f"keys of tables are long enough up to radius {MOST}")
    classes = written(prints.where("high IS NOT NULL AND low IS NOT NULL").groupBy("high", "low").agg(F.count("*").alias("n")), "classes")
    signed = [[v - (1 << 64) if v >> 63 else v for v in mask] for mask in key_masks(radius)]
    lists = [F.lit(t << 32).cast("long") + F.xxhash64(F.col("high").bitwiseAND(F.lit(left).cast("long")), F.col("low").bitwiseAND(F.lit(right).cast("long")))
             .bitwiseAND(F.lit(0xFFFFFFFF).cast("long")) for t, (left, right) in enumerate(signed)]
    posted = classes.select("high", "low", "n", F.explode(F.array(*lists)).alias("list"))
    # The share only decides how lists are dealt. At most about one key in ``block`` / 2 postings is long.
    share = max(1, block // 64)
    known = posted.where(F.pmod(F.xxhash64("low", "high"), F.lit(share)) == 0).groupBy("list").agg((F.count("*") * share).alias("members"))
    long = written(known.where(F.col("members") > block).select(F.col("list").alias("long_list"), F.ceil(F.col("members") / block).alias("blocks")), "long-lists")
    dealt = (posted.join(F.broadcast(long), F.col("list") == F.col("long_list"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("block", F.pmod(F.xxhash64("high", "low"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    a, b = F.least("block", "other"), F.greatest("block", "other")
    # a block by itself is 0 or negative, a pair of blocks positive
    dealt = dealt.select("list", F.when(a == b, -a).otherwise(F.shiftleft(a, 24) + b).alias("blocks"),
                         (F.col("block") == b).cast("long").alias("second"), "high", "low", "n")
    found = dealt.repartition("list", "blocks").sortWithinPartitions("list", "blocks").mapInArrow(_near(radius), "high long, low long, near long")
    near = found.groupBy("high", "low").agg(F.sum("near").alias("near"))
    return classes.join(near, ["high", "low"], "left").select("high", "low", "n", F.coalesce("near", F.lit(0)).alias("near"))


def with_near(rows: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``rows(high, low, ...)`` with ``n_near``: other rows within ``radius``, copies included; null for a row without
    a fingerprint. Rows of a fingerprint that many share stay where they are."""
    counts = near_counts(rows.select("high", "low"), radius, block)
    known = written(counts.select("high", "low", F.col("n").alias("_copies"), (F.col("n") - 1 + F.col("near")).alias("n_near")), "near")
    return join_classes(rows, known, ["high", "low"], "_copies", "left").drop("_copies")
