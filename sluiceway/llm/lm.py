"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

A token is a lower-cased word or the end of a text. The ``HEAD`` most frequent training tokens are
dealt to classes of ``WIDTH`` by frequency; all others, known or not, are one more class:

    P(token | context) = P(class | context) * P(token | class, context)

Both factors of a head token are softmaxes whose logits are the unigram's plus the weights of
hashed features of the context: the token before, the two before together, and the tokens two and
three before (skips). The class of the rest, which holds every other training token and one
unknown, is a tree of classes over their ranks by frequency: a node is split into ``WAYS`` spans of
near equal smoothed count (c + 0.1), until each is one token. Each turn is a softmax as well, whose
logits are the log shares of the spans plus rows of weights hashed from the node with the same four
contexts, told apart by their ranks. So every token has a path of its own, untrained weights
give its smoothed share of the class, and the model is a proper distribution over known tokens and one unknown.

Ranks need no tokens on the driver: counts by (total, slice of the hash) give where each slice
begins, and the number of tokens of each total, the ladder, gives the count of any span of ranks.
Slots and hashed weights grow with the distinct tokens, up to ``MOST_SLOTS`` and
``MOST_WEIGHTS``, which is what a worker and the driver hold; beyond, contexts share weights.

Passes: (1) each task turns texts into blocks, which hold codes into a block's list of
distinct tokens, and counts training tokens per block; (2) counts are summed by slice of the hash
and go back to the blocks that hold the token, both ways as one row of packed numbers for each block and
slice, so what is shuffled is a block's distinct tokens, not its text; (3) training: tasks run AdaGrad
over all training tokens of some blocks, and their weights are averaged by how often each row was seen
(parameter mixing), in groups of bounded size, as half-precision rows; (4) blocks are scored in batches
of numpy arrays. What comes to the driver is the ladder and the weights.

Tokens are told apart by 64 bits of XXH64: among ten billion distinct ones about three pairs would
be counted together.

Defined results: null and empty texts have the end token alone; repeated rows are counted and
scored each; a null id has its held-out remainder from the text ``null``; without training
tokens every token has probability 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_once
from .common import texts
from .vectors import chunks

HEAD, WIDTH = 480, 32  # with the rest 16 classes, so that a row of weights is 64 bytes
CLASSES = HEAD // WIDTH
SLOTS, MOST_SLOTS = 4096, 1 << 16  # hashed values of one template of features, at least and most
TEMPLATES = 4
WORD_WEIGHTS = 1 << 20  # of the head's words, and of the rest's tree at least
MOST_WEIGHTS = 1 << 24  # of the tree at most
WAYS = 16  # of a turn in the rest's tree, so that a row of its weights is 64 bytes too
SLICES = 1024  # of the hashes, which are counted and ranked apart
REST_BATCH = 1 << 13  # positions whose paths are followed together
SMOOTH = 0.1
RATE = 0.25
BATCH = 1 << 15  # tokens of a gradient step
BLOCK_CHARS = 14_000_000
#: Tokens of a block that are looked at together, about: whole texts.
SPAN_TOKENS = 250_000
#: Training tokens of a task, about: its weights are mixed with those of the other tasks. The largest model
#: shuffles 48 MB, about what so many tokens are as compressed text.
TASK_TOKENS = 16_000_000
MIXED = 8  # models mixed in one task
PART = 1 << 14  # weights in a row of a model
#: Fixed value: what the end of a text is hashed as; a word has no blank.
END = b" end"

_BLOCK = (
    "block long, ids array<long>, held array<boolean>, lengths array<int>, codes binary,"
    " order binary, hashes binary, counts binary"
)
_RANKED = "block long, ids array<long>, held array<boolean>, lengths array<int>, codes binary, ranks binary"


class _Block:
    """Texts of a task, until they are a block's worth."""

    def __init__(self):
        self.ids, self.held, self.texts = [], [], []
        self.chars = 0

    def add(self, doc: int | None, text: str, held: bool) -> None:
        self.ids.append(doc)
        self.held.append(held)
        self.texts.append(text)
        self.chars += len(text) + 1

    def row(self, number: int) -> pa.RecordBatch:
        texts_, self.texts = pa.array(self.texts, pa.large_string()), []
        tokens, codes, lengths = encoded_tokens(texts_)
        train = ~np.repeat(np.array(self.held, dtype=bool), lengths)
        counts = np.bincount(codes[train], minlength=len(tokens))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens)).view(np.int64)
        # In order of hash, so that a slice's are together.
        order = np.argsort(hashes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.ids], pa.list_(pa.int64())),
                pa.array([self.held], pa.list_(pa.bool_())),
                pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([in_planes(codes, "<i4")], pa.binary()),
                pa.array([in_planes(order, "<i4")], pa.binary()),
                pa.array([hashes[order].astype("<i8").tobytes()], pa.binary()),
                pa.array([in_planes(counts[order], "<i8")], pa.binary()),
            ],
            names=["block", "ids", "held", "lengths", "codes", "order", "hashes", "counts"],
        )


def in_planes(values: np.ndarray, kind: str) -> bytes:
    """Integers with their first bytes together, then their second ones, and so on.

    Most are small, so the planes of the higher bytes compress to nothing when written or shuffled.
    """
    whole = values.astype(kind)
    return whole.view(np.uint8).reshape(len(whole), whole.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def encoded_tokens(block: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A block's distinct tokens, the codes of all its tokens into them, and the tokens of each text.

    Lower-casing, splitting and encoding run in Arrow; the more frequent a token the
    smaller its code, which the written codes compress by.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(block))
    del block
    words = lists.flatten()
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    # Words up to the end of each text, without the empty ones beside blanks at its ends.
    offsets = lists.offsets.to_numpy()
    upto = np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]
    lengths = np.diff(upto)
    del lists
    if not full.all():
        words = words.filter(pa.array(full))
    known = words.dictionary_encode()
    del words
    tokens = [END, *(t.encode("utf-8", "surrogatepass") for t in known.dictionary.to_pylist())]
    codes = np.insert(known.indices.to_numpy() + 1, upto[1:], 0)
    order = np.argsort(-np.bincount(codes, minlength=len(tokens)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return [tokens[k] for k in order], place[codes], lengths + 1


def blocks(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoded blocks of documents; write them before reading, as their numbers are a task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for doc, text, held in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text", "held"))):
                now.add(doc, text, held)
                if now.chars >= BLOCK_CHARS:
                    yield now.row(number)
                    number, now = number + 1, _Block()
        if now.ids:
            yield now.row(number)

    return texts(docs, id_col, text_col, held_out.alias("held")).mapInArrow(run, _BLOCK)


def counted(encoded: DataFrame) -> DataFrame:
    """``slice``, ``block``, ``totals``, ``within``: of a block's tokens of a slice, in order of hash.

    ``totals``: training tokens in all blocks; ``within``: the token's place among those of its
    slice and total, the same in every block. Rows without a block have a slice's distinct totals and
    how many tokens have each.
    """

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                hashes = np.frombuffer(batch["hashes"][at].as_py(), "<i8")
                counts = from_planes(batch["counts"][at].as_py(), "<i8")
                # Arithmetic shifts keep the order of hashes, so slices are runs of it.
                part = hashes >> (64 - SLICES.bit_length() + 1)
                starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                runs = [slice(a, b) for a, b in zip(starts, np.append(starts[1:], len(part)))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[starts].astype(np.int32)),
                        pa.array(np.full(len(runs), batch["block"][at].as_py(), np.int64)),
                        pa.array([hashes[r].tobytes() for r in runs], pa.binary()),
                        pa.array([in_planes(counts[r], "<i8") for r in runs], pa.binary()),
                    ],
                    names=["slice", "block", "hashes", "counts"],
                )

    def summed(group: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(b, "<i8") for b in group["hashes"].to_pylist()]
        counts = np.concatenate([from_planes(b, "<i8") for b in group["counts"].to_pylist()])
        ends = np.cumsum([len(h) for h in hashes])
        known, at = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.zeros(len(known), np.int64)
        np.add.at(totals, at, counts)
        order = np.argsort(totals, kind="stable")
        levels, first, many = np.unique(totals[order], return_index=True, return_counts=True)
        within = np.empty(len(known), np.int64)
        within[order] = np.arange(len(known)) - np.repeat(first, many)
        trained = levels > 0
        of = [[in_planes(x[at[a:b]], "<i8") for a, b in zip(np.append(0, ends), ends)] for x in (totals, within)]
        return pa.table(
            {
                "slice": pa.array([group["slice"][0].as_py()] * (len(ends) + 1), pa.int32()),
                "block": pa.array([*group["block"].to_pylist(), None], pa.int64()),
                "totals": pa.array([*of[0], in_planes(levels[trained], "<i8")], pa.binary()),
                "within": pa.array([*of[1], in_planes(many[trained], "<i8")], pa.binary()),
            }
        )

    rows = encoded.select("block", "hashes", "counts").mapInArrow(dealt, "slice int, block long, hashes binary, counts binary")
    return rows.groupBy("slice").applyInArrow(summed, "slice int, block long, totals binary, within binary")


class Ladder:
    """How many of the rest's tokens have each training count, most frequent first, and one unknown last."""

    def __init__(self, totals: np.ndarray, tokens: np.ndarray):
        each = np.append(totals, 0) + SMOOTH
        many = np.append(tokens, 1).astype(np.int64)
        self.each, self.leaves = each, int(many.sum())
        self.starts = np.cumsum(many) - many
        self.mass = np.concatenate([[0.0], np.cumsum(many * each)[:-1]])

    def upto(self, rank: np.ndarray) -> np.ndarray:
        """The smoothed count of all tokens before ``rank``."""
        k = np.searchsorted(self.starts, rank, side="right") - 1
        return self.mass[k] + (rank - self.starts[k]) * self.each[k]

    def cuts(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The ranks at which spans begin that nodes are split into, and the nodes' ends: n, WAYS + 1.

        Spans have near equal smoothed counts and at least one token; a node of fewer tokens than
        ``WAYS`` has a span for each, and empty ones.
        """
        start, end = self.upto(low)[:, None], self.upto(high)[:, None]
        low, high, j = low[:, None], high[:, None], np.arange(1, WAYS)
        want = start + (end - start) * (j / WAYS)
        k = np.searchsorted(self.mass, want, side="right") - 1
        at = self.starts[k] + np.rint((want - self.mass[k]) / self.each[k]).astype(np.int64)
        at = np.maximum.accumulate(np.maximum(at - j, low), axis=1) + j
        at = np.where(high - low < WAYS, np.minimum(low + j, high), np.minimum(at, high - WAYS + j))
        return np.concatenate([low, at, high], axis=1)

    def paths(self, ranks: np.ndarray) -> Paths:
        """The way to each leaf; a node is named by its depth and first rank, which no other has."""
        known, place = np.unique(ranks, return_inverse=True)
        low, high = np.zeros(len(known), np.int64), np.full(len(known), self.leaves)
        owners, nodes, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        names, biases, named = [np.zeros(0, np.uint64)], [np.zeros((0, WAYS), np.float32)], 0
        going = np.flatnonzero(high - low > 1)
        while len(going):
            # In order of rank, so a node's leaves are together.
            begin = low[going]
            first = np.append(True, begin[1:] != begin[:-1])
            node, at = np.cumsum(first) - 1, going[first]
            cuts = self.cuts(low[at], high[at])
            mass = np.diff(self.upto(cuts), axis=1)
            shares = np.maximum(mass, 1e-30) / mass.sum(axis=1)[:, None]
            biases.append(np.where(mass > 0, np.log(shares), -1e9).astype(np.float32))
            names.append((low[at] * 64 + len(names)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            child = (cuts[node, 1:-1] <= known[going][:, None]).sum(axis=1)
            owners.append(going)
            nodes.append(named + node)
            children.append(child)
            low[going], high[going] = cuts[node, child], cuts[node, child + 1]
            going, named = going[high[going] - low[going] > 1], named + len(at)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(known) + 1))
        return Paths(
            place, bounds, np.concatenate(nodes)[order], np.concatenate(children)[order],
            np.concatenate(names), np.concatenate(biases),
        )


@dataclass(frozen=True)
class Paths:
    """``bounds[i]:bounds[i + 1]``, i = ``place`` of a leaf, are its turns: the node and the child taken.

    A node has the hash of its name and the log shares of its children.
    """

    place: np.ndarray
    bounds: np.ndarray
    nodes: np.ndarray
    children: np.ndarray
    names: np.ndarray
    biases: np.ndarray


@dataclass(frozen=True)
class Counts:
    """Training counts: all tokens, distinct tokens, and the head with its tokens' counts."""

    tokens: int
    distinct: int
    head: np.ndarray  # the tokens' names, hashes or ranks, most frequent first
    head_counts: np.ndarray
    ladder: Ladder | None = None  # without it the rest's tokens keep their shares
    #: All tokens by count and slice, in order of rank: count, slice, and the first rank.
    rungs: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __post_init__(self):
        order = np.argsort(self.head)
        object.__setattr__(self, "_sorted", self.head[order])
        object.__setattr__(self, "_order", order)

    def places(self, names: np.ndarray) -> np.ndarray:
        """Each token's place in the head, or -1."""
        if not len(self.head):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self._sorted, names), len(self.head) - 1)
        return np.where(self._sorted[at] == names, self._order[at], -1)

    def paths(self, head: np.ndarray, ranks: np.ndarray) -> Paths | None:
        """The ways to a block's tokens of the rest; tokens of the head stand at the unknown's."""
        if not self.ladder:
            return None
        return self.ladder.paths(np.where((ranks < 0) | (head >= 0), self.ladder.leaves - 1, ranks - len(self.head)))

    @property
    def slots(self) -> int:
        return min(MOST_SLOTS, max(SLOTS, 1 << (self.distinct // 32).bit_length()))

    @property
    def tree_weights(self) -> int:
        return min(MOST_WEIGHTS, max(WORD_WEIGHTS, 1 << (4 * self.distinct).bit_length()))

    def ranks(self, totals: np.ndarray, slices: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Ranks of tokens by count and hash; -1 of those without training tokens."""
        if self.rungs is None or not len(self.rungs[0]):
            return np.full(len(totals), -1)
        # As rungs are in falling order of counts and rising order of slices, one key has both.
        key = lambda n, k: -n * SLICES + k + SLICES // 2
        at = np.searchsorted(key(*self.rungs[:2]), key(totals, slices))
        first = self.rungs[2][np.minimum(at, len(self.rungs[2]) - 1)]
        return np.where(totals > 0, first + within, -1)

    def totals(self, ranks: np.ndarray) -> np.ndarray:
        """The training counts of ranks."""
        if self.rungs is None or not len(self.rungs[0]):
            return np.zeros(len(ranks), np.int64)
        return np.where(ranks >= 0, self.rungs[0][np.searchsorted(self.rungs[2], ranks, side="right") - 1], 0)

    @property
    def rest(self) -> int:
        return self.tokens - int(self.head_counts.sum())

    def class_bias(self) -> np.ndarray:
        """Log counts of the classes, the rest last."""
        padded = np.zeros(HEAD)
        padded[: len(self.head)] = self.head_counts
        sums = np.append(padded.reshape(CLASSES, WIDTH).sum(axis=1), self.rest + SMOOTH)
        return np.where(sums > 0, np.log(np.maximum(sums, 1e-30) / sums.sum()), -1e9).astype(np.float32)

    def word_bias(self) -> np.ndarray:
        padded = np.full(HEAD, -1e9)
        padded[: len(self.head)] = np.log(self.head_counts / max(1, self.tokens))
        return padded.astype(np.float32)

    def log_unigram(self, totals: np.ndarray) -> np.ndarray:
        return np.log10((totals + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))

    def log_rest(self, totals: np.ndarray) -> np.ndarray:
        """Log shares within the class of the rest."""
        return np.log10((totals + SMOOTH) / (self.rest + SMOOTH * (self.distinct - len(self.head) + 1)))


def count_summary(rows: DataFrame) -> Counts:
    found = rows.where("block IS NULL").select("slice", "totals", "within").toArrow()
    total, n = (
        np.concatenate([np.zeros(0, np.int64), *(from_planes(b, "<i8") for b in found[c].to_pylist())]) for c in ("totals", "within")
    )
    part = np.repeat(found["slice"].to_numpy().astype(np.int64), [len(b) // 8 for b in found["totals"].to_pylist()])
    order = np.lexsort((part, -total))
    total, part, n = total[order], part[order], n[order]
    ends = np.cumsum(n)
    top = np.arange(min(HEAD, int(n.sum())))
    # The ladder of what the head leaves.
    left = np.minimum(n, np.maximum(ends - len(top), 0))
    levels, at = np.unique(-total, return_inverse=True)
    many = np.bincount(at, left, len(levels)).astype(np.int64)
    return Counts(
        int((total * n).sum()), int(n.sum()), top, total[np.searchsorted(ends, top, side="right")],
        Ladder(-levels[many > 0], many[many > 0]), (total, part, ends - n),
    )


class Weights:
    """Weights of the features."""

    def __init__(self, slots: int = SLOTS, tree: int = WORD_WEIGHTS):
        self.slots = slots
        self.classes = np.zeros((TEMPLATES * slots, CLASSES + 1), np.float32)
        self.words = np.zeros((WORD_WEIGHTS // WIDTH, WIDTH), np.float32)
        self.tree = np.zeros((tree // WAYS, WAYS), np.float32)

    def parts(self) -> list[np.ndarray]:
        """All weights in order, as views of at most ``PART``."""
        flat = (one.reshape(-1) for one in (self.classes, self.words, self.tree))
        return [one[some] for one in flat for some in chunks(len(one), PART)]


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Rows of probabilities; logits are near log probabilities, so a clip keeps them finite."""
    np.clip(logits, -80, 80, out=logits)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], np.float32))[:, None]
    return logits


def slots_of(head: np.ndarray, hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """A slot for each head token; others share the remaining ones; 0 is before a text."""
    spread = (hashes.view(np.uint64) % np.uint64(slots - 1 - HEAD)).astype(np.int64)
    return np.where(head >= 0, 1 + head, 1 + HEAD + spread)


def spans(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Texts of a block in runs of about ``SPAN_TOKENS`` tokens: their places, and their tokens'."""
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        begun = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, begun + SPAN_TOKENS, side="right")))
        yield slice(first, last), slice(int(begun), int(ends[last - 1]))
        first = last


class Positions:
    """The positions of some texts: each token's place in the head, and its context's features.

    With the counts' ladder also the ways to the rest's tokens, and hashes of the ranks of the contexts.
    """

    paths: Paths | None = None

    def __init__(
        self, head: np.ndarray, slots: np.ndarray, codes: np.ndarray, lengths: np.ndarray,
        counts: Counts | None = None, ranks: np.ndarray | None = None, paths: Paths | None = None,
    ):
        many = counts.slots if counts else SLOTS
        self.target = head[codes]
        starts = np.cumsum(lengths) - lengths
        into = np.arange(len(codes)) - np.repeat(starts, lengths)

        def back(of: np.ndarray, k: int) -> np.ndarray:
            moved = np.zeros(len(of), of.dtype)
            moved[k:] = of[:-k]
            moved[into < k] = 0
            return moved

        one, two, three = (back(slots[codes].astype(np.int64), k) for k in (1, 2, 3))
        pair = ((one * 2654435761 + two * 40503) >> 7) % many
        self.features = np.stack([one, many + pair, 2 * many + two, 3 * many + three]).astype(np.uint32)
        if counts and counts.ladder:
            self.paths = paths or counts.paths(head, ranks)
            self.path = self.paths.place[codes]
            one, two, three = (back(ranks[codes].astype(np.uint64) + np.uint64(2), k) for k in (1, 2, 3))
            odd = [np.uint64(k) for k in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD)]
            pair = (one * odd[1] ^ two) * odd[0]
            self.contexts = np.stack([one * odd[0], pair, two * odd[2], three * odd[3]])

    def __len__(self) -> int:
        return len(self.target)

    def turns(self, rows: np.ndarray, weights: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all turns to the tokens at ``rows``: places of the rows of weights, nodes, children; and each token's number."""
        path = self.path[rows]
        first, many = self.paths.bounds[path], np.diff(self.paths.bounds)[path]
        ends = np.cumsum(many)
        at = np.arange(many.sum()) + np.repeat(first - ends + many, many)
        node = self.paths.nodes[at]
        mixed = np.repeat(self.contexts[:, rows], many, axis=1)
        mixed ^= self.paths.names[node]
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed >>= np.uint64(65 - weights.bit_length())
        return mixed.view(np.int64), node, self.paths.children[at], many


def _word_places(features: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Hashed rows of weights of the words of ``classes`` with each of the contexts: TEMPLATES, n."""
    mixed = (features.astype(np.uint64) * np.uint64(CLASSES) + classes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - (WORD_WEIGHTS // WIDTH).bit_length())).view(np.int64)


class Model:
    def __init__(self, counts: Counts, weights: Weights):
        self.weights = weights
        self.class_bias, self.word_bias = counts.class_bias(), counts.word_bias().reshape(CLASSES, WIDTH)

    def classes(self, features: np.ndarray) -> np.ndarray:
        """P(class | context), one row per position."""
        logits = np.take(self.weights.classes, features[0], axis=0)
        logits += self.class_bias
        for k in range(1, TEMPLATES):
            logits += np.take(self.weights.classes, features[k], axis=0)
        return _softmax(logits)

    def words(self, features: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(word | its class, context) of all words of the targets' classes, and the places of the rows of weights."""
        own = target // WIDTH
        places = _word_places(features, own)
        logits = np.take(self.word_bias, own, axis=0)
        for at in places:
            logits += np.take(self.weights.words, at, axis=0)
        return _softmax(logits), places

    def turns(self, positions: Positions, places: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """P(child | node, context), one row per turn."""
        logits = np.take(positions.paths.biases, nodes, axis=0)
        for at in places:
            logits += np.take(self.weights.tree, at, axis=0)
        return _softmax(logits)

    def log_within_rest(self, positions: Positions, rows: np.ndarray) -> np.ndarray:
        """log10 P of the tokens at ``rows`` within the class of the rest."""
        out = np.empty(len(rows))
        for some in chunks(len(rows), REST_BATCH):
            places, nodes, children, many = positions.turns(rows[some], len(self.weights.tree))
            p = self.turns(positions, places, nodes)[np.arange(len(nodes)), children].astype(np.float64)
            sums = np.concatenate([[0.0], np.cumsum(np.log10(np.maximum(p, 1e-30)))])
            ends = np.cumsum(many)
            out[some] = sums[ends] - sums[ends - many]
        return out

    def log_probability(self, positions: Positions, log_rest: np.ndarray) -> np.ndarray:
        """log10 P of each position; ``log_rest``: that of its token within the class of the rest, if there are no paths."""
        out = np.empty(len(positions))
        for some in chunks(len(positions), BATCH):
            features, target = positions.features[:, some], positions.target[some]
            in_head = target >= 0
            which = np.where(in_head, target // WIDTH, CLASSES)
            p = self.classes(features)[np.arange(len(target)), which].astype(np.float64)
            log_p = np.log10(np.maximum(p, 1e-30))
            if positions.paths is None:
                log_p[~in_head] += log_rest[some][~in_head]
            else:
                log_p[~in_head] += self.log_within_rest(positions, some.start + np.flatnonzero(~in_head))
            if in_head.any():
                own = target[in_head]
                q, _ = self.words(features[:, in_head], own)
                log_p[in_head] += np.log10(np.maximum(q[np.arange(len(own)), own % WIDTH].astype(np.float64), 1e-30))
            out[some] = log_p
        return out


class Trainer(Model):
    """AdaGrad on batches of positions."""

    def __init__(self, counts: Counts):
        w = Weights(counts.slots, counts.tree_weights)
        super().__init__(counts, w)
        self.class_squares, self.class_seen = np.ones(len(w.classes), np.float32), np.zeros(len(w.classes), np.float32)
        self.word_squares, self.word_seen = np.ones(len(w.words), np.float32), np.zeros(len(w.words), np.float32)
        self.tree_squares, self.tree_seen = np.ones(len(w.tree), np.float32), np.zeros(len(w.tree), np.float32)
        self.last = np.zeros(max(len(w.classes), len(w.words), len(w.tree)), np.int32)

    def step(self, features: np.ndarray, target: np.ndarray) -> None:
        n, w = len(target), self.weights
        in_head = target >= 0
        slope = self.classes(features)
        slope[np.arange(n), np.where(in_head, target // WIDTH, CLASSES)] -= 1
        for at in features:
            self._descend(w.classes, self.class_squares, self.class_seen, at.astype(np.intp), slope)
        if in_head.any():
            own = target[in_head]
            slope, places = self.words(features[:, in_head], own)
            slope[np.arange(len(own)), own % WIDTH] -= 1
            for at in places:
                self._descend(w.words, self.word_squares, self.word_seen, at, slope)

    def step_rest(self, positions: Positions, rows: np.ndarray) -> None:
        """The same for the turns to the rest's tokens at ``rows``."""
        for some in chunks(len(rows), REST_BATCH):
            places, nodes, children, _ = positions.turns(rows[some], len(self.weights.tree))
            slope = self.turns(positions, places, nodes)
            slope[np.arange(len(nodes)), children] -= 1
            for at in places:
                self._descend(self.weights.tree, self.tree_squares, self.tree_seen, at, slope)

    def _descend(self, weights: np.ndarray, squares: np.ndarray, seen: np.ndarray, at: np.ndarray, slope: np.ndarray) -> None:
        """A step of the rows ``at``, down their summed slopes; rows not met are not touched, however many there are."""
        each, wide = np.arange(len(at), dtype=np.int32), weights.shape[1]
        self.last[at] = each
        met = at[self.last[at] == each]
        self.last[met] = each[: len(met)]
        own = self.last[at].astype(np.intp)
        sums = np.zeros((len(met), wide), np.float32)
        # Flat, which numpy adds up some times faster than rows.
        np.add.at(sums.reshape(-1), ((own * wide)[:, None] + np.arange(wide)).reshape(-1), slope.reshape(-1))
        past = squares[met] + np.einsum("ij,ij->i", sums, sums)
        squares[met] = past
        sums *= (RATE / np.sqrt(past))[:, None]
        weights[met] = np.take(weights, met, axis=0) - sums
        seen[met] += np.bincount(own, minlength=len(met))

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number, weights, and how often each row of them was seen, of the parts that were."""
        seen = [
            one[some]
            for one, wide in ((self.class_seen, CLASSES + 1), (self.word_seen, WIDTH), (self.tree_seen, WAYS))
            for some in chunks(len(one), PART // wide)
        ]
        for k, (own, many) in enumerate(zip(self.weights.parts(), seen, strict=True)):
            if many.any():
                yield k, own, many


def _opened(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Held-out flags, lengths, codes and ranks of a block's row in a batch."""
    held = np.array(batch["held"][at].as_py(), dtype=bool)
    lengths = batch["lengths"][at].values.to_numpy().astype(np.int64)
    codes = from_planes(batch["codes"][at].as_py(), "<i4")
    return held, lengths, codes, from_planes(batch["ranks"][at].as_py(), "<i8")


def train(encoded: DataFrame, counts: Counts) -> Weights:
    """One pass of distributed gradient updates over all training tokens."""
    total = counts.tokens
    if not total or not len(counts.head):
        return Weights(counts.slots, counts.tree_weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Trainer(counts)
        for batch in batches:
            for at in range(batch.num_rows):
                held, lengths, codes, ranks = _opened(batch, at)
                head = counts.places(ranks)
                slots, paths = slots_of(head, ranks, counts.slots), counts.paths(head, ranks)
                for docs, tokens in spans(lengths):
                    positions = Positions(head, slots, codes[tokens], lengths[docs], counts, ranks, paths)
                    trained = np.flatnonzero(~np.repeat(held[docs], lengths[docs]))
                    for some in chunks(len(trained), BATCH):
                        rows = trained[some]
                        own.step(positions.features[:, rows], positions.target[rows])
                        own.step_rest(positions, rows[positions.target[rows] < 0])
        task = TaskContext.get().partitionId()
        for part in own.parts():
            yield _model_row(task, *part)

    kinds = "task long, part int, weights binary, seen binary"
    tasks = max(1, round(total / TASK_TOKENS))
    models = encoded.select("held", "lengths", "codes", "ranks").coalesce(tasks).mapInArrow(run, kinds)

    def mixed(group: pa.Table) -> pa.Table:
        weighted, seen = 0.0, 0.0
        for own, many in zip(group["weights"].to_pylist(), group["seen"].to_pylist()):
            many = np.frombuffer(many, np.float32).astype(np.float64)
            weighted = weighted + np.frombuffer(own, np.float16).reshape(len(many), -1) * many[:, None]
            seen = seen + many
        mean = weighted / np.maximum(seen, 1)[:, None]
        return pa.Table.from_batches([_model_row(group["task"][0].as_py(), group["part"][0].as_py(), mean, seen)])

    left = tasks
    while left > 1:
        # A bounded number of models in each group, however many tasks trained.
        some = models.withColumn("task", F.floor(F.col("task") / MIXED).cast("long"))
        models = write_once(some.groupBy("task", "part").applyInArrow(mixed, kinds), "lm-weights")
        left = -(-left // MIXED)
    weights = Weights(counts.slots, counts.tree_weights)
    parts = weights.parts()
    for row in models.select("part", "weights").collect():
        parts[row.part][:] = np.frombuffer(row.weights, np.float16)
    return weights


def _model_row(task: int, part: int, weights: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([task], pa.int64()),
            pa.array([part], pa.int32()),
            pa.array([weights.astype(np.float16).tobytes()], pa.binary()),
            pa.array([seen.astype(np.float32).tobytes()], pa.binary()),
        ],
        names=["task", "part", "weights", "seen"],
    )


def _ranked(encoded: DataFrame, rows: DataFrame, counts: Counts) -> DataFrame:
    """The blocks with ``ranks``, those of their distinct tokens, in order of code."""

    def joined(block: pa.Table, parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("slice")
        totals, within = ([from_planes(b, "<i8") for b in parts[c].to_pylist()] for c in ("totals", "within"))
        slices = np.repeat(parts["slice"].to_numpy().astype(np.int64), [len(t) for t in totals])
        order = from_planes(block["order"][0].as_py(), "<i4")
        ranks = np.empty(len(order), np.int64)
        ranks[order] = counts.ranks(np.concatenate(totals), slices, np.concatenate(within))
        return block.drop_columns("order").append_column("ranks", pa.array([in_planes(ranks, "<i8")], pa.binary()))

    own = encoded.drop("hashes", "counts").groupBy("block")
    return own.cogroup(rows.where("block IS NOT NULL").groupBy("block")).applyInArrow(joined, _RANKED)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's unigram score and the model's log10 probability of its text.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. The counts and the model learn from
    the documents for which ``held_out`` is not true.
    """
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False))
    encoded = write_once(blocks(docs, held, id_col, text_col), "lm-blocks")
    rows = write_once(counted(encoded), "lm-counts")
    counts = count_summary(rows)
    joined = write_once(_ranked(encoded, rows, counts), "lm-ranked")
    weights = spark.sparkContext.broadcast(train(joined, counts))
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(counts, weights.value)
        for batch in batches:
            for at in range(batch.num_rows):
                held, lengths, codes, ranks = _opened(batch, at)
                totals = counts.totals(ranks)
                head, ids = counts.places(ranks), batch["ids"][at].values
                paths = counts.paths(head, ranks)
                slots, known = slots_of(head, ranks, counts.slots), (totals > 0).astype(np.int64)
                unigram, rest = counts.log_unigram(totals), counts.log_rest(totals)
                for docs, tokens in spans(lengths):
                    own, n = codes[tokens], lengths[docs]
                    starts = np.cumsum(n) - n
                    log_p = model.log_probability(Positions(head, slots, own, n, counts, ranks, paths), rest[own])
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(docs.start, docs.stop - docs.start),
                            pa.array(held[docs]),
                            pa.array(n),
                            pa.array(np.add.reduceat(known[own], starts)),
                            pa.array(np.full(len(n), counts.tokens, np.int64)),
                            pa.array(np.add.reduceat(unigram[own], starts)),
                            pa.array(np.add.reduceat(log_p, starts)),
                        ],
                        names=list(names),
                    )

    return joined.mapInArrow(run, SCORES)
