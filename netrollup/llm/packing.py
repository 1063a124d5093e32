"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Documents become pieces: token ids and an end id, cut into pieces of the sequence length of
which the first may be shorter.  A full piece is a sequence.  The others are dealt to
partitions of a bounded size; each is packed by best-fit decreasing and compared with the
lower bound that dual-feasible functions give for its pieces.  A partition that meets its bound
is done.  One with a gap is packed in a second way, and if the gap stays, keeps its full sequences and
hands the pieces of all others on; those are dealt anew, so partitions exchange them, and packed
again, for as long as that takes fewer sequences than they had.

Defined cases: a null text is empty (its piece is the end id alone); rows with equal or null ids
are packed like any other row; no rows give no rows.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrollup.llm.common import gives_back, staged

LENGTH = 2048
PIECES_PER_PART = 8192
_SPECIAL = "<|endoftext|>"
# Runs that the faster encoder's pattern handles badly.
_LONG_WORD, _LONG_SPACE = 5000, re.compile(r"\s{200}")

_worker: dict = {}


def token_bytes(path: str, ranks: str | None = None):
    """A function from a text to its ids as little-endian unsigned 32-bit integers.

    ``path`` is a tokenizer of the ``tokenizers`` library.  ``ranks`` may name the same byte-level
    vocabulary as ranks, from which ``tiktoken`` makes the same ids in a third of the time;
    texts that hold a special token's name or very long runs still go the first way, which is loaded
    when the first of them comes.
    """
    if _worker.get("paths") != (path, ranks):
        fast = None
        if ranks is not None:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                order = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=order, special_tokens={})
        _worker.update(paths=(path, ranks), whole=None, fast=fast)
    fast = _worker["fast"]

    def whole():
        if _worker["whole"] is None:
            from tokenizers import Tokenizer

            _worker["whole"] = Tokenizer.from_file(path)
        return _worker["whole"]

    def encode(text: str) -> bytes:
        if (fast is None or _SPECIAL in text or _LONG_SPACE.search(text)
                or len(text) > _LONG_WORD and max(map(len, text.split()), default=0) > _LONG_WORD):
            return np.array(whole().encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    return encode


PIECES = ("uid long, doc_id long, piece int, start long, length long, ids_crc32 long")


def tokenize_pieces(docs: DataFrame, tokenizer: str, *, ranks: str | None = None,
                    id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                    end_id: int = 0) -> DataFrame:
    """One row per piece, with a row number that is unique in the result."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(tokenizer, ranks)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(value.as_py() or "") + end
                n = len(ids) // 4
                start, stop, piece = 0, (n - 1) % length + 1, 0
                while start < n:
                    rows.append((uid, doc, piece, start, stop - start,
                                 zlib.crc32(ids[4 * start:4 * stop])))
                    uid, start, stop, piece = uid + 1, stop, stop + length, piece + 1
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [
                    pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()],
                    strict=True)],
                names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text).cast("string")).mapInArrow(
        gives_back(cut), PIECES)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Bin and offset of each item, and the bins' fill.  Bins are kept by the room they have left,
    so the fullest bin that an item fits is one bit operation away."""
    bins, offsets, fill = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        room -= size
        if room:
            with_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets, fill


def even_fill(sizes: np.ndarray, capacity: int, number: int):
    """The same with ``number`` bins filled evenly: largest pieces first, each into the emptiest bin,
    then bins that overflow swap a piece for a smaller one of a bin with room.  None if one still
    overflows.  For sizes of which a few make a bin, where best fit leaves a hole in every one."""
    size = sizes.tolist()
    held: list[list[int]] = [[] for _ in range(number)]
    heap = [(0, b) for b in range(number)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        load, b = heap[0]
        held[b].append(i)
        heapq.heapreplace(heap, (load + size[i], b))
    loads = [0] * number
    for load, b in heap:
        loads[b] = load
    # For every size the bins that hold one, emptiest first; entries may be out of date.
    holders: dict[int, list[tuple[int, int]]] = {}
    for b in range(number):
        for i in held[b]:
            holders.setdefault(size[i], []).append((loads[b], b))
    for entries in holders.values():
        heapq.heapify(entries)

    def emptiest(wanted: int) -> int | None:
        entries = holders.get(wanted, [])
        while entries:
            load, b = entries[0]
            if loads[b] == load and any(size[i] == wanted for i in held[b]):
                return b
            heapq.heappop(entries)
        return None

    def swap_for(b: int) -> tuple[int, int, int] | None:
        """Own piece, other bin and size there that bring bin ``b`` to the capacity, or near it."""
        over = loads[b] - capacity
        own = sorted({size[i]: i for i in held[b]}.items())
        most = own[-1][0] if own else 0
        for less in (*range(over, most), *range(min(over, most) - 1, 0, -1)):
            for x, i in own:
                other = emptiest(x - less) if x > less else None
                if other is not None and loads[other] + less <= capacity:
                    return i, other, x - less
        return None

    for b in sorted(range(number), key=lambda b: -loads[b]):
        while loads[b] > capacity:
            found = swap_for(b)
            if found is None:
                return None
            i, other, wanted = found
            j = next(k for k in held[other] if size[k] == wanted)
            held[b].remove(i)
            held[other].remove(j)
            held[b].append(j)
            held[other].append(i)
            for changed, by in ((b, size[j] - size[i]), (other, size[i] - size[j])):
                loads[changed] += by
                for k in held[changed]:
                    heapq.heappush(holders[size[k]], (loads[changed], changed))
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for b, pieces in enumerate(held):
        at = 0
        for i in pieces:
            bins[i], offsets[i] = b, at
            at += size[i]
    return bins, offsets, loads


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the dual-feasible functions that count items over
    ``capacity - k`` as whole, drop those below ``k`` and take the rest as they are, and of those
    that round sizes down to multiples of 1 / (k + 1)."""
    if not len(sizes):
        return 0
    counts = np.bincount(sizes, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    n, words = np.cumsum(counts), np.cumsum(counts * size)
    best = -(-int(words[-1]) // capacity)
    for k in range(1, capacity // 2 + 1):
        whole = n[-1] - n[capacity - k]
        middle = words[capacity - k] - words[k - 1]
        best = max(best, int(whole) - (-int(middle) // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def pack_sizes(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list, bool]:
    """Bins, offsets and fill, and whether the bound certifies that no packing has fewer bins.  Where
    best fit has a gap to the bound, fewer bins are filled evenly; their number is halved in."""
    least = lower_bound(sizes, capacity)
    best = best_fit_decreasing(sizes, capacity)
    low, number = least, least
    while low < len(best[2]):
        found = even_fill(sizes, capacity, number)
        if found:
            best = found
        else:
            low = number + 1
        number = (low + len(best[2])) // 2
    return *best, len(best[2]) <= least


def _pack_part(capacity: int):
    """Packs one partition.  ``open``: the piece's sequence has room and its partition a gap."""
    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("uid")
        uid, sizes = rows.column("uid").to_numpy(), rows.column("length").to_numpy()
        bins, offsets, fill, met = pack_sizes(sizes, capacity)
        first = np.full(len(fill), -1, np.int64)  # a bin is named by the piece at its start
        first[bins[offsets == 0]] = uid[offsets == 0]
        loose = np.array(fill) < capacity
        return pa.table({
            "uid": uid, "length": sizes, "sequence_id": first[bins], "offset": offsets,
            "open": loose[bins] & (not met)})

    return pack


def pack(pieces: DataFrame, *, length: int = LENGTH,
         part_rows: int = PIECES_PER_PART) -> DataFrame:
    """``pieces`` with ``sequence_id`` (the uid of the piece at its start) and ``offset``."""
    full = pieces.where(F.col("length") >= length).select(
        "*", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") < length)
    places = ["uid", "sequence_id", "offset"]
    placed, before, round_ = [], None, 0
    todo, left = short.select("uid", "length"), short.count()
    while left:
        parts = -(-left // part_rows)
        packed = staged(
            todo.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(parts)))
            .groupBy("part").applyInArrow(
                _pack_part(length),
                "uid long, length long, sequence_id long, offset long, open boolean"),
            f"pack-{round_}")
        # Sequences, by the pieces at their starts; those of partitions with a gap; their pieces.
        starts = F.col("uid") == F.col("sequence_id")
        made = packed.agg(F.count_if(starts).alias("all"), F.count_if(starts & F.col("open"))
                          .alias("open"), F.count_if("open").alias("pieces")).first()
        if before is not None and made["all"] >= before["open"]:
            # The exchange has gained nothing: the round before stays.
            placed.append(earlier.select(places))
            break
        if before is not None:
            placed.append(earlier.where(~F.col("open")).select(places))
        earlier, before = packed, made
        if parts == 1 or not made["open"]:
            placed.append(packed.select(places))
            break
        todo, left, round_ = packed.where("open").select("uid", "length"), made["pieces"], round_ + 1
    if not placed:
        return full
    found = placed[0]
    for more in placed[1:]:
        found = found.unionByName(more)
    return full.unionByName(short.join(found, "uid"))


def pack_documents(docs: DataFrame, tokenizer: str, *, ranks: str | None = None,
                   id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   end_id: int = 0, part_rows: int = PIECES_PER_PART) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = staged(tokenize_pieces(docs, tokenizer, ranks=ranks, id_col=id_col, text=text,
                                    length=length, end_id=end_id), "pieces")
    return pack(pieces, length=length, part_rows=part_rows).drop("uid")
