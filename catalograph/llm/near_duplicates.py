"""Near duplicates by SimHash: fingerprints, linked through a byte-position inverted index.

Two 64-bit fingerprints with at most 3 differing bits differ in at most 3 of their 8 bytes, so they share at
least 5 positional bytes. A posting list of one positional byte would hold 1/256 of all fingerprints, so
the index posts each fingerprint under joint positions: the 14 quadruples of positions whose numbers XOR to
zero. Any 5 positions contain one of these quadruples, hence every wanted pair meets in some list, and a list is
keyed by 32 bits. In a list the shared positional bytes of each pair are tallied, pairs below the guaranteed
minimum are dropped, and the rest is verified bit by bit.

Only distinct fingerprints enter the index, so copies never pair up. A list emits a spanning forest of
its links, not the links: at most one row per member. Longer lists than ``block`` are dealt as pairs of blocks
to several tasks, each of bounded size, so all members of a list are compared at any length.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.components import components
from catalograph.llm.tables import join_classes, written

SEED = 42
BITS = 64
QUADRUPLES = tuple(q for q in itertools.combinations(range(8), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0)
BLOCK = 4096
_STEP, _PART = 1 << 14, 1 << 20  # hashes unpacked, and bytes of a text split, at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, those of about ``_PART`` bytes at a time. On bytes, lower() changes A-Z only, and white
    space is exactly 0x20 and 0x09 to 0x0D."""
    start = 0
    while start < len(text):
        found = _SPACE.search(text, start + _PART)
        end = found.start() if found else len(text)
        yield text[start:end].lower().split()
        start = end


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """Hashes of all shingles of ``width`` words, space-joined; of fewer words, that of the whole sequence."""
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[:len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())),
                       np.uint64, len(starts))


def fingerprint(text: bytes, width: int = 3) -> int:
    """Bit by bit: set where more than half of the shingle hashes have it set; no word gives zero."""
    votes, number = np.zeros(BITS, np.int64), 0
    words: list[bytes] = []  # not yet hashed, with the last words of what was
    for part in _parts(text):
        words += part
        if len(words) >= width:
            for hashes in _some(_hashes(words, width)):
                votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int32)
                number += len(hashes)
            words = words[len(words) - width + 1:] if width > 1 else []
    if words and not number:
        return int(_hashes(words, width)[0])
    return int.from_bytes(np.packbits(2 * votes > number, bitorder="little").tobytes(), "little")


def _some(hashes: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(hashes), _STEP):
        yield hashes[at:at + _STEP].astype("<u8")


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """64-bit fingerprint of a text column as a signed long; a null text counts as empty."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        values = (fingerprint(x.as_py() or b"", width) for x in texts.cast(pa.binary()))
        return pa.array(np.fromiter(values, np.uint64, len(texts)).view(np.int64))

    return of(text)


def _postings(prints: DataFrame) -> DataFrame:
    """``(list, fingerprint)``: one row per fingerprint and quadruple of byte positions."""
    byte = [F.shiftrightunsigned("fingerprint", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    lists = []
    for number, quadruple in enumerate(QUADRUPLES):
        value = F.lit(number).cast("long")
        for i in quadruple:
            value = F.shiftleft(value, 8).bitwiseOR(byte[i])
        lists.append(value)
    return prints.select(F.explode(F.array(*lists)).alias("list"), "fingerprint")


def _dealt(postings: DataFrame, block: int) -> DataFrame:
    """Lists of two members or more, as groups ``(list, a, b)`` of at most about two blocks of members."""
    sizes = postings.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    return (postings.join(sizes, "list").withColumn("blocks", blocks).withColumn("own", own)
            .select("list", "fingerprint", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("list", "fingerprint", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))


def _forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, by blockwise breadth-first search."""
    least_shared = 8 - radius
    todo = np.arange(len(members))
    u, v = [], []
    while len(todo):
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):
            parent = np.full(len(todo), -1)
            for node in front.tolist():
                open_ = np.flatnonzero(parent < 0)
                if not len(open_):
                    break
                differing = members[todo[open_]] ^ members[node]
                shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(1)
                kept = np.flatnonzero(shared >= least_shared)
                hit = kept[np.bitwise_count(differing[kept]) <= radius]
                parent[open_[hit]] = node
            found = parent >= 0
            u.append(parent[found])
            v.append(todo[found])
            front, todo = todo[found], todo[~found]
    if not u:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(u), np.concatenate(v)


def _pairs_of_two(groups: np.ndarray, members: np.ndarray, radius: int) -> np.ndarray:
    """Places where a group of exactly two members is linked, over many groups at once."""
    differing = members[groups] ^ members[groups + 1]
    shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(1)
    return groups[(shared >= 8 - radius) & (np.bitwise_count(differing) <= radius)]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, (None,)):
            if batch is None:
                if held is None:
                    return
                keys, last = held, True
            else:
                now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
                keys, last = (now if held is None else np.concatenate((held, now), axis=1)), False
            if not keys.shape[1]:
                continue
            starts = np.concatenate(([0], np.flatnonzero((keys[:3, 1:] != keys[:3, :-1]).any(0)) + 1))
            if not last:  # the last group may go on in the next batch
                held, keys, starts = keys[:, starts[-1]:], keys[:, :starts[-1]], starts[:-1]
            members = keys[3].view(np.uint64)
            sizes = np.diff(np.append(starts, keys.shape[1]))
            two = _pairs_of_two(starts[sizes == 2], members, radius)
            u, v = [keys[3][two]], [keys[3][two + 1]]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                a, b = _forest(members[start:start + size], radius)
                u.append(keys[3][start + a])
                v.append(keys[3][start + b])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return run


def fingerprint_links(prints: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` that connect exactly the fingerprints connected at ``radius`` or fewer differing bits.

    ``prints`` has a long column ``fingerprint``, each value once; null values take no part. The links
    are a spanning forest per posting list: every true link joins two fingerprints of one component here.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the index guarantees a shared quadruple of bytes up to radius 3")
    dealt = _dealt(_postings(prints.where("fingerprint is not null")), block)
    return (dealt.repartition("list", "a", "b").sortWithinPartitions("list", "a", "b")
            .select("list", "a", "b", "fingerprint").mapInArrow(_links(radius), "u long, v long"))


def row_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id, text_hash, fingerprint)`` per row, written once: all later steps are narrow."""
    return written(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                               fingerprint_column(F.col(text_col), width).alias("fingerprint")), "prints")


def with_components(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``prints(id, fingerprint, ...)`` with ``component``, the least fingerprint reachable over links, and
    ``component_id``, the least id reachable.

    Equal fingerprints are linked at distance 0. Null ids do not count for the least id; a component with
    null ids only has a null ``component_id``. Repeated rows stay repeated; an empty table gives no row.
    """
    classes = written(prints.groupBy("fingerprint").agg(F.min("id").alias("least_id"), F.count("*").alias("copies")), "classes")
    roots = components(fingerprint_links(classes.select("fingerprint"), radius))
    linked = roots.join(classes, roots.node == classes.fingerprint).select("root", "node", "least_id")
    least = linked.groupBy("root").agg(F.min("least_id").alias("root_id"))
    moved = linked.join(least, "root").select(F.col("node").alias("fingerprint"), "root", "root_id")
    known = (classes.join(moved, "fingerprint", "left")
             .select("fingerprint", "copies", F.coalesce("root", "fingerprint").alias("component"),
                     F.coalesce("root_id", "least_id").alias("component_id")))
    return join_classes(prints, written(known, "components"), ["fingerprint"], "copies").drop("copies")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 3) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row of ``docs``; see ``fingerprint`` and ``with_components``.

    A null text counts as empty and has fingerprint zero, as has any text without a word. Other columns of
    ``docs`` are not read, whatever their names.
    """
    return with_components(row_prints(docs, id_col, text_col, width), radius).select(
        "id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
             radius: int = 3) -> DataFrame:
    """Rows of ``docs`` that represent their component: the one with the least id, all columns unchanged.

    Ties of the id go to the smaller text hash (null ids come last), and of rows equal in id and text one is
    kept. Text moves once, keyed by id and text, so no group of copies meets in one task.
    """
    grouped = with_components(row_prints(docs, id_col, text_col, width), radius)
    order = F.struct(F.col("id").isNull(), "id", "text_hash")
    kept = grouped.groupBy("component").agg(F.min(order).alias("first"))
    kept = kept.select(F.col("first.id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash")).distinct()
    same = docs[id_col].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs[text_col]) == kept["kept_hash"])
    left = docs.join(kept, same, "left_semi")
    return left.dropDuplicates([id_col, text_col])
