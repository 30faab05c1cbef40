"""Spelling variants: words one edit apart, by k-d trees over letter counts.

A word is a point: how often it has each letter. One replaced letter changes two
counts by one (one up, one down), one inserted letter changes one, so words one
edit apart lie within an L1 distance of two, and the box search may leave a
word's own box by one letter more and one fewer at most. For each word length a
k-d tree over a bounded sample of words cuts the space into leaves. A word is a
member of one leaf of its length's tree; it visits the other leaves whose box it
reaches there, and those that it reaches by one letter more in the tree of the
next length. A leaf is joined in one task by a k-d tree of its own; the letter
order of what is left decides. Each pair meets once, and a task returns, per
word, the number of its near words and the most frequent one, so what moves on
grows with the words.

Defined cases: null and empty texts have no words; a null doc_id is written as
an empty string before the colon of the hash. Rows that repeat a doc_id count
again. An empty table gives no rows. Words are never cut, whatever their length,
and texts are read whole, a piece at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm import grid
from dealspark.llm.common import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
BREAK = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: One in so many runs of a document loses a letter (the digest's test noise, fixed value).
NOISE = 97
#: Characters of a text whose runs are held at a time.
PIECE = 1 << 20
#: Distinct words that a task holds before it hands on their counts.
HELD = 200_000

#: Words that the shared trees are fitted on, at most; every word is routed through them.
SAMPLE = 20_000
#: Words in a leaf of the shared trees, about.
LEAF = 4096
#: Members and visitors of a leaf that one task compares, at most.
MEMBERS, VISITORS = 32_768, 200_000
#: Words that are compared letter by letter.
DIRECT = 48
#: Letters compared in one step.
STEP = 1 << 22


def _runs(data: bytes) -> Iterator[list[str]]:
    """The lower-cased letter runs of a text, in lists of bounded size."""
    text, start = data.translate(LOWER).decode(), 0
    while start < len(text):
        cut = BREAK.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield RUN.findall(text, start, end)
        start = end


def noisy(run: str, seed: int) -> str:
    """``run``, or ``run`` without a letter where its hash, carried on from ``seed``, says so."""
    h = zlib.crc32(run.encode(), seed)
    if h % NOISE:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, shortest: int = 5) -> DataFrame:
    """(word, n) of all rows of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for runs in _runs(text.as_py()):
                    for word, n in Counter(runs).items():
                        if len(word) >= shortest:
                            word = noisy(word, seed)
                            if len(word) >= shortest:
                                total[word] += n
                    if len(total) > HELD:
                        yield flush()
        yield flush()

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> np.ndarray:
    """(words, length) uint8: words of one length; all letters are Latin-1."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(spelt: np.ndarray) -> np.ndarray:
    """(words, 90): a-z, then U+00C0 to U+00FF."""
    code = np.where(spelt >= 0xC0, spelt.astype(np.int64) - 0xC0 + 26, spelt.astype(np.int64) - 97)
    out = np.zeros((len(spelt), 90), np.uint8 if spelt.shape[1] < 256 else np.int32)
    np.add.at(out, (np.repeat(np.arange(len(spelt)), spelt.shape[1]), code.ravel()), 1)
    return out


@dataclass
class Node:
    """Words with at most ``most`` letters ``letter`` go left, the others right."""
    letter: int
    most: int
    left: Node | int
    right: Node | int


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """(letter, most) that halves the words best; None where they all have the same letters."""
    best = None
    middle = np.median(counts, axis=0).astype(np.int32)
    for shift in (0, -1):
        most = middle + shift
        left = (counts <= most).sum(0)
        uneven = np.where((left > 0) & (left < len(counts)), np.abs(2 * left - len(counts)), len(counts))
        k = int(uneven.argmin())
        if uneven[k] < len(counts):
            best = min(best or (int(uneven[k]), k, int(most[k])), (int(uneven[k]), k, int(most[k])))
    return None if best is None else best[1:]


def shared_tree(counts: np.ndarray, leaf: int) -> Node | int:
    """A tree with ``leaf`` of the sampled words in a leaf, about; leaves are numbered."""
    made = 0

    def grow(held: np.ndarray) -> Node | int:
        nonlocal made
        cut = _split(held) if len(held) > leaf else None
        if cut is None:
            made += 1
            return made - 1
        left = held[:, cut[0]] <= cut[1]
        return Node(*cut, grow(held[left]), grow(held[~left]))

    return grow(counts)


@dataclass
class Search:
    """Words on their way down: ``more`` and ``fewer`` letters that each may
    still gain or lose to reach the boxes below; ``low`` and ``high`` bound the box."""
    at: np.ndarray
    member: np.ndarray
    more: np.ndarray
    fewer: np.ndarray

    def take(self, which: np.ndarray) -> Search:
        return Search(self.at[which], self.member[which], self.more[which], self.fewer[which])


def start(n: int, member: bool, more: int, fewer: int) -> Search:
    return Search(np.arange(n), np.full(n, member), np.full(n, more, np.int32), np.full(n, fewer, np.int32))


def step(counts: np.ndarray, search: Search, letter: int, most: int, low: np.ndarray, high: np.ndarray) -> tuple[Search, Search]:
    """The words that go on to the left and the right of a cut of the box from ``low`` to ``high``.

    Members go to their own side. Those of the left also visit the right where
    its box is in reach, visitors go wherever a box is in reach.
    """
    own = counts[search.at, letter].astype(np.int64)
    left = own <= most
    # a visitor may stand outside the box already: what that took is given back before the new bound counts
    fewer = search.fewer + np.maximum(own - high[letter], 0) - np.maximum(own - most, 0)
    more = search.more + np.maximum(low[letter] - own, 0) - np.maximum(most + 1 - own, 0)
    goes_left = np.where(search.member, left, fewer >= 0)
    goes_right = np.where(search.member, ~left | (more >= 0), more >= 0)
    to_left = Search(search.at, search.member, search.more, np.where(left, search.fewer, fewer)).take(goes_left)
    to_right = Search(search.at, search.member & ~left, np.where(left, more, np.where(search.member, search.more, more)),
                      search.fewer).take(goes_right)
    return to_left, to_right


def _bounded(low: np.ndarray, high: np.ndarray, letter: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The upper bounds of the left box and the lower ones of the right one."""
    upper, lower = high.copy(), low.copy()
    upper[letter], lower[letter] = min(upper[letter], most), max(lower[letter], most + 1)
    return upper, lower


def route(node: Node | int, counts: np.ndarray, search: Search, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, Search]]:
    if not len(search.at):
        return
    if isinstance(node, int):
        yield node, search
        return
    left, right = step(counts, search, node.letter, node.most, low, high)
    upper, lower = _bounded(low, high, node.letter, node.most)
    yield from route(node.left, counts, left, low, upper)
    yield from route(node.right, counts, right, lower, high)


def _everything() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(90, np.int64), np.full(90, 1 << 40)


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each word of ``a`` and each of ``b``, of one length, differ in exactly one place."""
    return (a[:, None, :] != b[None, :, :]).sum(2) == 1


def inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each word of ``long`` is one of ``short`` with one letter more."""
    n = short.shape[1]
    head = short[:, None, :] == long[None, :, :n]
    tail = short[:, None, ::-1] == long[None, :, :0:-1]
    same = [np.where(x.all(2), n, x.argmin(2)) for x in (head, tail)]
    return same[0] + same[1] >= n


def _compare(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    wide = max(1, STEP // max(1, a.shape[1]))
    columns = min(len(at_b), wide)
    rows = max(1, wide // max(1, columns))
    for k in range(0, len(at_b), max(1, columns)):
        for j in range(0, len(at_a), rows):
            x, y = np.nonzero(near(a[at_a[j:j + rows]], b[at_b[k:k + columns]]))
            yield at_a[j + x], at_b[k + y]


def pairs_in(members: np.ndarray, visitors: np.ndarray, shorter: np.ndarray, itself: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, x, y): member x is near member y (0), visitor y (1) or shorter visitor
    y (2). Words come as letters; visitors have the members' length."""
    counted = [letter_counts(w) for w in (members, visitors, shorter)]

    def down(at: np.ndarray, same: Search, less: Search, low: np.ndarray, high: np.ndarray) -> Iterator:
        if not len(at) or (len(at) < 2 and not len(same.at) and not len(less.at)) or not (itself or len(same.at) or len(less.at)):
            return
        cut = _split(counted[0][at]) if len(at) > DIRECT else None
        if cut is None:
            if itself:
                for x, y in _compare(members, at, members, at, replaced):
                    yield 0, x[x < y], y[x < y]
            own = same.at < len(members)
            for x, y in _compare(members, at, members, same.at[own], replaced):
                yield 0, x, y
            for x, y in _compare(members, at, visitors, same.at[~own] - len(members), replaced):
                yield 1, x, y
            for y, x in _compare(shorter, less.at, members, at, inserted):
                yield 2, x, y
            return
        left = counted[0][at, cut[0]] <= cut[1]
        same_left, same_right = step(both, same, *cut, low, high)
        less_left, less_right = step(counted[2], less, *cut, low, high)
        if itself:
            # members on the left visit the right
            near = at[left]
            reach = cut[1] - counted[0][near, cut[0]].astype(np.int64) <= 0
            gone = start(int(reach.sum()), False, 0, 1)
            gone.at = near[reach]
            same_right = Search(*[np.concatenate([getattr(same_right, f), getattr(gone, f)]) for f in ("at", "member", "more", "fewer")])
        upper, lower = _bounded(low, high, *cut)
        yield from down(at[left], same_left, less_left, low, upper)
        yield from down(at[~left], same_right, less_right, lower, high)

    both = np.concatenate([counted[0], counted[1]])
    same = start(len(visitors), False, 1, 1)
    same.at = same.at + len(members)
    yield from down(np.arange(len(members)), same, start(len(shorter), False, 1, 0), *_everything())


NEAR = "word string, n_near long, best_n long, best string"
NEAR_ARROW = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _near_in_cell(group: pa.Table) -> pa.Table:
    """Per word of a cell: its near words there, and the most frequent of them (ties: the smallest)."""
    words, ns = group.column("word").to_pylist(), group.column("n").to_numpy()
    role, length = group.column("role").to_numpy(), group.column("length")[0].as_py()
    short = np.array([len(w) < length for w in words], bool)
    parts = {name: np.flatnonzero(which) for name, which in (
        ("first", role == grid.FIRST), ("again", role == grid.AGAIN), ("same", (role == grid.VISIT) & ~short),
        ("shorter", (role == grid.VISIT) & short))}
    spelt = {name: letters([words[k] for k in at.tolist()]) if len(at) else np.zeros((0, length - (name == "shorter")), np.uint8)
             for name, at in parts.items()}
    ends = [[], []]
    for own, itself in (("first", True), ("again", False)):
        for kind, x, y in pairs_in(spelt[own], spelt["same"], spelt["shorter"], itself):
            x, y = parts[own][x], parts[(own, "same", "shorter")[kind]][y]
            ends[0] += [x, y]
            ends[1] += [y, x]
    none = np.zeros(0, np.int64)
    a, b = (np.concatenate([none, *e]) for e in ends)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -ns[b], a))
    word, first, n_near = np.unique(a[order], return_index=True, return_counts=True)
    best = b[order][first]
    return pa.table([pa.array([words[k] for k in word.tolist()], pa.string()), pa.array(n_near.astype(np.int64)),
                     pa.array(ns[best]), pa.array([words[k] for k in best.tolist()], pa.string())], schema=NEAR_ARROW)


def near_words(words: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(word, n_near, best_n, best) of the ``words`` (word, n) that have near ones;
    best is the near word of largest n (ties: the smallest)."""
    total = words.count()
    chosen = words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word")
    size = max(16, leaf * min(SAMPLE, total) // max(total, 1))
    trees = {r["length"]: shared_tree(np.frombuffer(r["counts"], np.int32).reshape(-1, 90), size)
             for r in chosen.groupBy(F.length("word").alias("length")).applyInArrow(_counted, "length int, counts binary").agg(
                 F.collect_list(F.struct("length", "counts"))).first()[0]}  # the sample's counts: bounded

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, ns = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            sizes = np.array([len(w) for w in held])
            for length in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == length)
                counts = letter_counts(letters([held[k] for k in at.tolist()]))
                for tree, search in ((length, start(len(at), True, 1, 1)), (length + 1, start(len(at), False, 1, 0))):
                    for place, found in route(trees.get(tree, 0), counts, search, *_everything()):
                        mine = at[found.at]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(mine), tree, np.int32)), pa.array(np.full(len(mine), place, np.int32)),
                             pa.array([held[k] for k in mine.tolist()], pa.string()), pa.array(ns[mine]), pa.array(found.member)],
                            ["length", "leaf", "word", "n", "member"])

    placed = stored(words.select("word", "n").mapInArrow(routed, "length int, leaf int, word string, n long, member boolean"), "spelling_routed")
    cells = grid.dealt(placed, ["length", "leaf"], "word", MEMBERS, VISITORS)
    found = cells.groupBy("length", "leaf", "member_part", "visitor_part").applyInArrow(_near_in_cell, NEAR)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), "b.best")


def _counted(group: pa.Table) -> pa.Table:
    words = group.column("word").to_pylist()
    return pa.table({"length": pa.array([len(words[0])], pa.int32()), "counts": pa.array([letter_counts(letters(words)).astype(np.int32).tobytes()], pa.binary())})


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: pointers that double their reach
    until none moves. Forms at least double n, so a chain has under 64 words."""
    reach = stored(forms, "spelling_reach")
    while True:
        beyond = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(reach.join(beyond, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling_reach")
        reach = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reach


def variants(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``docs`` (doc_id,
    text) with ``shortest`` letters and ``least`` occurrences or more."""
    words = stored(word_counts(docs, shortest).where(F.col("n") >= least), "spelling_words")
    near = words.join(near_words(words), "word", "left")
    holds = F.col("best_n") >= 2 * F.col("n")
    known = stored(near.select("word", F.when(holds, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(holds, F.col("best_n")).alias("form_n")), "spelling_known")
    roots = _roots(known.where("form is not null").select("word", F.col("form").alias("root")))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
