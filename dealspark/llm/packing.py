"""Best-fit packing of token sequences, certified by lower bounds.

Documents become token ids (a separator ends each) and are cut only where they
are longer than a sequence. Pieces are dealt to groups; in each group best-fit
decreasing fills sequences, and those without a gap are final. Dual-feasible
functions give a lower bound on the number of the others; if it is met, all
groups are certified. Else the pieces of sequences with a gap are dealt anew,
so groups exchange documents, and packed again, until they are certified, form
one group, gain nothing more, or ``ROUNDS`` is reached.

Only lengths and places travel; a group holds a bounded number of pieces, so
no task grows with the corpus, and pieces spread evenly whatever their source.

Defined cases: a null or empty text is the separator alone (one token). Very
long texts become full pieces after a shorter first one. Repeated rows are
packed as documents of their own. An empty table packs to no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm.common import stored

CAPACITY = 2048
SEPARATOR = 0
#: Pieces in a group at most, on average.
GROUP = 40_000

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"

#: How the byte-level pre-tokenizer of the ``tokenizers`` library splits text (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[str, Callable[[str], bytes]] = {}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes -> id of a plain byte-level BPE file whose merges stand in the order of their ids; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not model.get("dropout") and not spec.get("normalizer")
             and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True))
    if not plain:
        return None
    # the byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 onwards
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    special = {t["content"] for t in spec.get("added_tokens", ())}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)) or len(vocab) != 256 + len(merges):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocab.items()}


def token_ids(path: str) -> Callable[[str], bytes]:
    """Text -> its ids by the ``tokenizers`` file at ``path``, little-endian uint32,
    without special tokens; one per Python worker.

    Where the file is a plain byte-level BPE, its ranks and pattern run in
    tiktoken, which gives the same ids several times faster; others run in
    ``tokenizers`` itself.
    """
    if path not in _loaded:
        ranks = _ranks(path)
        if ranks:
            import tiktoken
            fast = tiktoken.Encoding("packing", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
            _loaded[path] = lambda text: fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            _loaded[path] = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return _loaded[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text); ``row`` tells
    repeated doc_ids apart. Only the first piece of a cut document is short."""
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = [[] for _ in range(6)]
                ids, rows = part.column(0).to_pylist(), part.column(1).to_pylist()
                for doc_id, row, text in zip(ids, rows, part.column(2).to_pylist()):
                    data = memoryview(encode(text or "") + end)
                    n = len(data) // 4
                    first = (n - 1) % capacity + 1
                    cuts = [0, *range(first, n + 1, capacity)]
                    for k, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                        for column, v in zip(out, (doc_id, row, k, start, stop - start,
                                                   zlib.crc32(data[4 * start:4 * stop]))):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(out)],
                    ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    picked = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"),
                         F.col("text").cast("string"))
    return picked.mapInArrow(run, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each piece: longest first, into the fullest bin where it fits."""
    bins = np.zeros(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # distinct rooms, ascending
    made = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                del by_room[room], rooms[at]
        else:
            b, room, made = made, capacity, made + 1
        bins[k] = b
        left = room - size
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(b)
    return bins


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing of ``counts`` pieces of each size needs, by two
    families of dual-feasible functions (their values over the pieces of any one
    sequence add up to 1 at most)."""
    if not len(sizes):
        return 0
    best = -(-int((sizes * counts).sum()) // capacity)
    for t in np.unique(np.minimum(sizes, capacity - sizes)):
        # a piece over capacity - t counts whole, one under t not at all
        whole, part = sizes > capacity - t, (sizes >= t) & (sizes <= capacity - t)
        best = max(best, int(counts[whole].sum()) - int(-(sizes[part] * counts[part]).sum() // capacity))
    for k in range(1, 33):
        # (k + 1) shares of the capacity, rounded down, over k; exact multiples keep their size
        shares = (k + 1) * sizes
        scaled = np.where(shares % capacity == 0, shares * k, (shares // capacity) * capacity * (k + 1))
        best = max(best, -(-int((scaled * counts).sum()) // (capacity * k * (k + 1))))
    return best


PACKED = "row long, piece int, length long, sequence_id long, offset long, final boolean"


def _pack_groups(items: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Best-fit decreasing in each of ``groups``; ``final`` tells the pieces of certified groups and of full sequences."""

    def pack(batch: pa.Table) -> pa.Table:
        lengths = batch.column("length").to_numpy()
        rows, numbers = batch.column("row").to_numpy(), batch.column("piece").to_numpy()
        order = np.lexsort((numbers, rows, -lengths))  # independent of the order in which rows arrive
        lengths, rows, numbers = lengths[order], rows[order], numbers[order]
        bins = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        by_bin = np.argsort(bins, kind="stable")
        starts = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        offset = np.empty(len(bins), np.int64)
        offset[by_bin] = starts - np.concatenate([[0], np.cumsum(fill)[:-1]])[bins[by_bin]]
        values, counts = np.unique(lengths, return_counts=True)
        certified = len(fill) == lower_bound(values, counts, capacity)
        sequence = (turn << 50) + (int(batch.column("part")[0].as_py()) << 24) + bins
        return pa.table({"row": rows, "piece": pa.array(numbers, pa.int32()), "length": lengths,
                         "sequence_id": sequence, "offset": offset,
                         "final": certified | (fill[bins] == capacity)})

    part = F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(groups))
    return items.select("row", "piece", "length", part.alias("part")).groupBy("part").applyInArrow(pack, PACKED)


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(row, piece, sequence_id, offset) for rows (row, piece, length <= capacity).

    Each round packs the pieces that are not final in new groups. One that does
    not save a sequence is not used, and one that saves less than a sequence per
    group is the last, so the number of rounds does not grow with the corpus.
    """
    place = ("row", "piece", "sequence_id", "offset")
    pool, held, fewest = items, None, None
    done = []
    for turn in count():
        groups = max(1, -(-pool.count() // group))
        packed = stored(_pack_groups(pool, groups, turn, capacity), "packed")
        made = packed.where("offset = 0").count()
        if held is not None and made >= fewest:
            break
        done.append(packed.where("final").select(*place))
        saved = None if held is None else fewest - made
        held = packed.where("not final")
        fewest = held.where("offset = 0").count()
        if fewest == 0 or groups == 1 or (saved is not None and saved < groups):
            break
        pool = held
    done.append(held.select(*place))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``."""
    cut = stored(pieces(docs, path, capacity, separator), "pieces")
    placed = pack(cut, capacity)
    return cut.join(placed, ["row", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
