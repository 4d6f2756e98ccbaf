"""Language-model scores: online logistic context mixing over bytes, beside a smoothed unigram base.

The model predicts a text's bytes (A-Z lower-cased, one zero byte as the end) bit by bit. Six predictors, of orders 0
to 5, look at the bits of the byte so far and at the bytes before it, and have a counter of zeros and ones for every such
context that the training part contains: no two contexts share one, and none is left out. Their stretched probabilities are mixed by weights that a gate selects (how many orders have seen their context and
how often the longest of them), and the mixed probability is refined by an adaptive map per bit
position and bits so far. A text's score is the sum of the logarithms of all bit probabilities.

What is learned, and how. Counters hold what the whole training part contains: tasks count byte 6-grams, Spark adds
them up, and counters follow from the sums, since whatever an order needs is a part of the 6-gram. Distinct grams are sharded by the
``SHARD_ORDER`` bytes before the last, so that a shard holds all that the counters of these and longer contexts need;
those of shorter ones are broadcast. Weights are learned online, in mini-batches in a stream of a shard's grams weighted by
their counts, in parallel over shards, then averaged; the adaptive map is counted in a second pass. In both, an occurrence is left out of the counters that predict it, as it will not be in them
when a new text is scored. Scoring freezes the model: scores then do not depend on which texts a task reads first, nor
on lost executors. Every bit depends on the 6-gram only, so shards compute the cost of every distinct gram, of texts held out too, once.
The costs of the most frequent grams, ``FREQUENT_GRAMS`` at most, are broadcast; occurrences of others are joined with
the costs by gram.

The base: tokens are words and one end per text. Counts come from the same pass. The most frequent words, ``FREQUENT`` at
most, are broadcast; occurrences of others are joined with the counts by word.

How it scales. Two passes over the texts. What tasks count is flushed when it grows, and combined before shuffles. The
number of shards follows the number of distinct grams; the model's counters are in no one place.
The driver gets counts of trigrams (2**24 there are, a dense row of 256 for each pair of bytes met), weights, the frequent grams
and words, all bounded.

Defined results: a null text is an empty one: its only token and byte is the end. Without training documents all
counts are 0, and the model predicts by its initial weights. Null keys count as the empty text in the split. Repeated rows
count as often as they come. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .text import objects, per_process, remainder

ORDERS = 6
# Sizes of the tables of a model whose contexts are not numbered, see ``slots_of``; ``score`` numbers all of them.
TABLE_BITS = (8, 16, 18, 20, 21, 21)
TABLE_START = tuple(int(sum(1 << b for b in TABLE_BITS[:o])) for o in range(ORDERS + 1))
GRAM = ORDERS  # bytes of a gram: the longest context and the byte itself
SHARD_ORDER = 3
GRAMS_PER_SHARD = 250_000

SMOOTHING = 0.1
FREQUENT = 300_000
FREQUENT_GRAMS = 1 << 21

# Words a task counts before it passes them on, bytes handled in one numpy step, grams evaluated in one.
HELD_WORDS = 300_000
HELD_GRAMS = 2_500_000
BLOCK = 1 << 21
GRAM_BLOCK = 1 << 15
COST_BLOCK = 1 << 13
MEMO_BITS = 22

# Mixing: inputs are the orders' stretched probabilities and a constant.
LEVELS, BANDS = ORDERS, 4
GATES = LEVELS * BANDS
DELTA = 0.35
REACH = 9.0
RATE, EPOCHS, BATCH = 0.3, 4, 2048
TRAINING_PARTS = 8

CONSTANT = 0.3

# Adaptive map: cells per unit of stretched probability, and how many observations its prior is worth.
CELLS_PER_UNIT = 2
CELLS = int(2 * REACH * CELLS_PER_UNIT) + 1
MAP_PRIOR = 32.0

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def held_out(key: Column) -> Column:
    return remainder(key, 10) == 0


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; its ``split()`` gives the words, whose separators are ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


# --- grams -------------------------------------------------------------------------------------


def blocks(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grams of texts, in blocks of about ``BLOCK``: grams, and owner and start of each run of one text's grams."""
    lead = bytes(GRAM - 1)
    parts, owners, sizes, held = [], [], [], 0

    def flush():
        codes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        # Every part starts with GRAM - 1 bytes of context, whose own grams are not wanted.
        ends = np.cumsum(np.array(sizes) + len(lead))
        wanted = np.ones(len(codes), dtype=bool)
        for k in range(len(lead)):
            wanted[ends - np.array(sizes) - len(lead) + k] = False
        grams = np.zeros(max(0, len(codes) - GRAM + 1), dtype=np.uint64)
        for k in range(GRAM):
            grams <<= np.uint64(8)
            grams |= codes[k : k + len(grams)]
        return grams[wanted[GRAM - 1 :]], np.array(owners), np.cumsum(sizes) - np.array(sizes)

    for owner, data in texts:
        data = lead + data + b"\0"
        for start in range(len(lead), len(data), BLOCK):
            part = data[start - len(lead) : start + BLOCK]
            parts.append(part)
            owners.append(owner)
            sizes.append(len(part) - len(lead))
            held += len(part)
            if held >= BLOCK:
                yield flush()
                parts, owners, sizes, held = [], [], [], 0
    if parts:
        yield flush()


def corpus_statistics(docs: DataFrame, text: str, held: Column) -> DataFrame:
    """Partial counts of all texts: ``gram`` or ``word`` (the other is null; the empty word is the end), ``n`` of the
    training part and, for grams, ``met`` in all texts. Words are those of the training part."""

    def grams_of(grams: np.ndarray, counts: np.ndarray, met: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"gram": pd.array(grams.astype(np.int64), dtype="Int64"), "word": None, "n": counts, "met": met})

    def words_of(words: Counter) -> pd.DataFrame:
        none, n = pd.array([None] * len(words), dtype="Int64"), list(words.values())
        return pd.DataFrame({"gram": none, "word": list(words), "n": n, "met": n})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        words: Counter = Counter()

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            grams, place = np.unique(np.concatenate([p[0] for p in pending]), return_inverse=True)
            return grams, *(np.bincount(place, np.concatenate([p[k] for p in pending])).astype(np.int64) for k in (1, 2))

        def parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[bytes], bool]]:
            for batch in batches:
                held = batch["held"].to_numpy(dtype=bool)
                for which in (False, True):
                    yield [lowered(t) for t in batch["text"][held == which]], which

        for data, is_held in parts(batches):
            for one in () if is_held else data:
                words.update(one.split())
                if len(words) > HELD_WORDS:
                    yield words_of(words)
                    words = Counter()
            if data and not is_held:
                words[b""] += len(data)
            for block, _, _ in blocks(enumerate(data)):
                found, met = np.unique(block, return_counts=True)
                pending.append((found, met * (not is_held), met))
                if sum(len(p[0]) for p in pending) > HELD_GRAMS:
                    pending = [merged()]
                    if len(pending[0][0]) > HELD_GRAMS // 2:
                        yield grams_of(*pending.pop())
        if pending:
            yield grams_of(*merged())
        if words:
            yield words_of(words)

    rows = docs.select(F.col(text).alias("text"), held.alias("held"))
    return rows.mapInPandas(counted, "gram long, word binary, n long, met long")


# --- the model -----------------------------------------------------------------------------------


def bits_of(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits (gram, bit) of the last byte, and the bits so far."""
    target = (grams & np.uint64(255)).astype(np.int64)
    depth = np.arange(8)
    return (target[:, None] >> (7 - depth)) & 1, (1 << depth) | (target[:, None] >> (8 - depth))


class Short:
    """Counters of the contexts below ``SHARD_ORDER``: a row of 256 bits so far for each, and one of zeros for all others."""

    def __init__(self, trigrams: np.ndarray, n: np.ndarray):
        pairs, row = np.unique(trigrams >> 8, return_inverse=True)
        counts = np.bincount(row * 256 + (trigrams & 255), n, minlength=256 * len(pairs)).reshape(-1, 256)
        self.row, self.zeros, self.ones = [], [], []
        for order in range(SHARD_ORDER):
            known, at = np.unique(pairs & ((1 << (8 * order)) - 1), return_inverse=True)
            bytes_of = np.zeros((len(known) + 1, 256))
            np.add.at(bytes_of, at, counts)
            place = np.full(1 << (8 * order), len(known), dtype=np.int32)
            place[known] = np.arange(len(known))
            sums = np.zeros((2, len(bytes_of), 256), dtype=np.float32)
            for depth in range(8):
                halves = bytes_of.reshape(len(bytes_of), 1 << depth, 2, -1).sum(axis=-1)
                sums[:, :, 1 << depth : 2 << depth] = np.moveaxis(halves, -1, 0)
            self.row.append(place)
            self.zeros.append(sums[0].ravel())
            self.ones.append(sums[1].ravel())

    def of(self, order: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Zeros and ones of an order's nodes (context, bits so far)."""
        at = self.row[order][nodes >> 8].astype(np.int64) * 256 + (nodes & 255)
        return self.zeros[order][at], self.ones[order][at]


class Shard:
    """Exact counters of all contexts of a shard's grams, numbered; the counters of an order follow those of the one before."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, short: Short):
        self.grams, self.n = grams, n
        self.bits, self.so_far = bits_of(grams)
        context = (grams >> np.uint64(8)).astype(np.int64)
        self.slots, zeros, ones, first = [], [], [], 0
        for order in range(ORDERS):
            known = context & ((1 << (8 * order)) - 1)
            nodes, at = np.unique((known[:, None] << 8) | self.so_far, return_inverse=True)
            at = at.reshape(self.bits.shape)
            if order < SHARD_ORDER:
                found = short.of(order, nodes)
            else:
                share = n[:, None].astype(float)
                found = [np.bincount(at.ravel(), (share * which).ravel(), minlength=len(nodes)) for which in (1 - self.bits, self.bits)]
            zeros.append(found[0])
            ones.append(found[1])
            self.slots.append((at + first).astype(np.int32))
            first += len(nodes)
        self.zeros, self.ones = (np.concatenate(x).astype(np.float32) for x in (zeros, ones))

    def __len__(self) -> int:
        return len(self.grams)

    def part(self, chosen) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """What ``slots_of`` returns, of some of the grams."""
        return [at[chosen] for at in self.slots], self.bits[chosen], self.so_far[chosen]


def slots_of(grams: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order the counter slots (gram, bit), hashed into ``TABLE_BITS``; the bits, and the bits so far."""
    context = grams >> np.uint64(8)
    bits, so_far = bits_of(grams)
    step = so_far.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    slots = []
    for order in range(ORDERS):
        known = context & np.uint64((1 << (8 * order)) - 1)
        if order < 2:
            cell = (known[:, None] << np.uint64(8)).astype(np.int64) | so_far
        else:
            mixed_context = (known ^ (known >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
            cell = (mixed_context ^ (mixed_context >> np.uint64(32)))[:, None] + step
            cell = ((cell * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - TABLE_BITS[order])).astype(np.int64)
        slots.append(cell + TABLE_START[order])
    return slots, bits, so_far


def stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + DELTA) / (n0 + DELTA)), -REACH, REACH)


def band_of(total: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 and more the more often it was."""
    return np.where(total > 0, 1 + np.minimum(np.log2(total + 1) / 3, BANDS - 1).astype(np.uint8), 0).astype(np.uint8)


def gate_of(bands: np.ndarray) -> np.ndarray:
    """The gate, from the orders' bands (order, ...): how many orders have seen their context, and the longest's band."""
    level = (bands[1:] > 0).sum(axis=0)
    longest = np.take_along_axis(bands, level[None], axis=0)[0]
    return level * BANDS + np.maximum(longest, 1) - 1


def inputs(slots: list[np.ndarray], zeros: np.ndarray, ones: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixer inputs (..., order + constant) and the gate, ``bits`` being taken out of the counters that predict them."""
    values, bands = [], []
    for at in slots:
        n1 = np.maximum(ones[at] - bits, 0)
        n0 = np.maximum(zeros[at] - (1 - bits), 0)
        values.append(stretch(n0, n1))
        bands.append(band_of(n0 + n1))
    values.append(np.full(bits.shape, CONSTANT))
    return np.stack(values, axis=-1), gate_of(np.stack(bands))


def initial_weights() -> np.ndarray:
    weights = np.zeros((GATES, ORDERS + 1))
    weights[:, :ORDERS] = 0.25
    return weights


def mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Stretched mixed probability of a 1."""
    return np.clip((x * weights[gate]).sum(axis=-1), -REACH, REACH)


def squash(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def cell_of(z: np.ndarray) -> np.ndarray:
    return np.rint((z + REACH) * CELLS_PER_UNIT).astype(np.int64)


def learn_weights(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Online mixing weights over a stream of a shard's grams, and how much each gate was used."""
    weights = initial_weights()
    used = np.zeros(GATES)
    order = np.argsort(shard.grams * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            slots, bits, _ = shard.part(chosen)
            x, gate = inputs(slots, shard.zeros, shard.ones, bits)
            share = np.repeat(shard.n[chosen], 8).astype(float)
            x, gate, bits = x.reshape(-1, ORDERS + 1), gate.ravel(), bits.ravel()
            error = (bits - squash(mixed(x, gate, weights))) * share
            total = np.bincount(gate, share, minlength=GATES)
            for i in range(ORDERS + 1):
                weights[:, i] += rate * np.bincount(gate, error * x[:, i], minlength=GATES) / np.maximum(total, 1)
            used += total
    return weights, used


def count_map(shard: Shard, weights: np.ndarray) -> np.ndarray:
    """Observations of the adaptive map: (ones or all, bits so far, cell)."""
    result = np.zeros((2, 256 * CELLS))
    for start in range(0, len(shard), GRAM_BLOCK):
        part = slice(start, start + GRAM_BLOCK)
        slots, bits, so_far = shard.part(part)
        x, gate = inputs(slots, shard.zeros, shard.ones, bits)
        cell = (so_far * CELLS + cell_of(mixed(x, gate, weights))).ravel()
        share = np.repeat(shard.n[part], 8).astype(float)
        result[0] += np.bincount(cell, share * bits.ravel(), minlength=256 * CELLS)
        result[1] += np.bincount(cell, share, minlength=256 * CELLS)
    return result


def refined_map(observed: np.ndarray) -> np.ndarray:
    """Probability of a 1 per bits so far and cell."""
    center = squash(np.arange(CELLS) / CELLS_PER_UNIT - REACH)
    prior = np.tile(center, 256)
    return (observed[0] + MAP_PRIOR * prior) / (observed[1] + MAP_PRIOR)


def packed(arrays: Sequence[np.ndarray]) -> list[tuple[bytes, str, tuple[int, ...]]]:
    """Arrays for a broadcast; tables that are mostly empty shrink to what they hold."""
    return [(zlib.compress(a.tobytes(), 1), a.dtype.str, a.shape) for a in arrays]


def unpacked(arrays: Sequence[tuple[bytes, str, tuple[int, ...]]]) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(data), dtype=kind).reshape(shape) for data, kind, shape in arrays]


def frozen(zeros: np.ndarray, ones: np.ndarray, weights: np.ndarray, refined: np.ndarray):
    """The model as scoring reads it: per slot the stretched probability and band, then weights and adaptive map."""
    values = stretch(zeros, ones).astype(np.float32)
    return values, band_of(zeros + ones), weights.astype(np.float32), refined.astype(np.float32)


def costs(grams: np.ndarray, model, slots_at=None) -> np.ndarray:
    """Logarithm of the probability of each gram's last byte given the others; ``slots_at`` gives the slots of a part of them."""
    values, bands, weights, refined = model
    result = np.empty(len(grams))
    for start in range(0, len(grams), COST_BLOCK):
        part = slice(start, start + COST_BLOCK)
        slots, bits, so_far = slots_at(part) if slots_at else slots_of(grams[part])
        gate = gate_of(np.stack([bands[at] for at in slots]))
        z = weights[:, ORDERS][gate] * np.float32(CONSTANT)
        for order, at in enumerate(slots):
            z += values[at] * weights[:, order][gate]
        np.clip(z, -REACH, REACH, out=z)
        p = np.clip((squash(z) + refined[so_far * CELLS + cell_of(z)]) / 2, 1e-6, 1 - 1e-6).astype(np.float64)
        result[part] = np.log(np.where(bits == 1, p, 1 - p)).sum(axis=1)
    return result


class Memo:
    """Costs of grams already met, in a direct-mapped table; a gram whose place is taken is computed anew."""

    @classmethod
    def of(cls, name: str, load, evaluate) -> Memo:
        """The worker's memo, which lasts as long as it scores by the model called ``name``."""
        held = per_process("memo", dict)
        if name not in held:
            held.clear()
            held[name] = cls(load(), evaluate)
        return held[name]

    def __init__(self, model, evaluate=costs):
        self.model, self.evaluate = model, evaluate
        self.gram = np.full(1 << MEMO_BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.cost = np.zeros(1 << MEMO_BITS, dtype=np.float32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        place = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        result = self.cost[place].astype(np.float64)
        missed = np.flatnonzero(self.gram[place] != grams)
        if len(missed):
            new, inverse = np.unique(grams[missed], return_inverse=True)
            value = self.evaluate(new, self.model)
            result[missed] = value[inverse].astype(np.float32)
            at = ((new * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
            free = self.gram[at] == np.iinfo(np.uint64).max
            at, first = np.unique(at[free], return_index=True)
            self.gram[at] = new[free][first]
            self.cost[at] = value[free][first]
        return result


def listed(grams: np.ndarray, table: Sequence[np.ndarray]) -> np.ndarray:
    """Costs from a table of sorted grams and their costs; NaN for grams that it does not list."""
    known, cost = table
    if not len(known):
        return np.full(len(grams), np.nan)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    return np.where(known[at] == grams, cost[at], np.nan)


def gram_costs(grams: DataFrame, workspace: Workspace, per_shard: int = GRAMS_PER_SHARD) -> DataFrame:
    """``gram``, ``met`` and ``cost`` from ``gram``, ``n`` and ``met``, one row per gram."""
    context = grams.sparkSession.sparkContext
    shards = max(TRAINING_PARTS, -(-grams.count() // per_shard))
    spread = grams.repartition(shards, F.shiftrightunsigned("gram", 8).bitwiseAND((1 << (8 * SHARD_ORDER)) - 1))
    trained = spread.filter("n > 0")
    ends = grams.filter("n > 0").groupBy(F.col("gram").bitwiseAND((1 << (8 * SHARD_ORDER)) - 1).alias("gram"))
    counted = ends.agg(F.sum("n").alias("n")).toArrow()
    counts = context.broadcast(packed([counted[c].to_numpy() for c in ("gram", "n")]))
    del counted

    def whole(batches: Iterator[pd.DataFrame]) -> tuple[Shard, np.ndarray] | None:
        parts = [p for p in batches if len(p)]
        if not parts:
            return None
        found = {c: np.concatenate([p[c].to_numpy() for p in parts]) for c in ("gram", "n", "met")}
        return Shard(found["gram"].astype(np.uint64), found["n"], Short(*unpacked(counts.value))), found["met"]

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if found := whole(batches):
            weights, used = learn_weights(found[0])
            gate = np.repeat(np.arange(GATES), ORDERS + 1)
            place = np.tile(np.arange(ORDERS + 1), GATES)
            yield pd.DataFrame({"gate": gate, "input": place, "weight": weights.ravel(), "used": used[gate]})

    weights = initial_weights()
    average = F.sum(F.col("weight") * F.col("used")) / F.sum("used")
    learned = trained.mapInPandas(weigh, "gate int, input int, weight double, used double").filter("used > 0")
    for row in learned.groupBy("gate", "input").agg(average.alias("weight")).collect():
        weights[row["gate"], row["input"]] = row["weight"]

    def observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if found := whole(batches):
            seen = count_map(found[0], weights)
            at = np.flatnonzero(seen[1])
            yield pd.DataFrame({"cell": at, "ones": seen[0, at], "n": seen[1, at]})

    observed = np.zeros((2, 256 * CELLS))
    watched = trained.mapInPandas(observe, "cell int, ones double, n double")
    for row in watched.groupBy("cell").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).collect():
        observed[:, row["cell"]] = row["ones"], row["n"]
    refined = refined_map(observed)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if found := whole(batches):
            shard, met = found
            model = frozen(shard.zeros, shard.ones, weights, refined)
            cost = costs(shard.grams, model, shard.part)
            yield pd.DataFrame({"gram": shard.grams.astype(np.int64), "met": met, "cost": cost})

    return workspace.write(spread.mapInPandas(evaluate, "gram long, met long, cost double"), "costs")


# --- scoring -------------------------------------------------------------------------------------


def least_count(table: DataFrame, most: int, n: str = "n") -> int | None:
    """The least count of the most frequent rows: as many whole classes of equal counts as fit into ``most``."""
    classes = table.groupBy(n).count()
    # Fewer than sqrt(2 N) different counts can add up to N rows.
    least, room = None, most
    for row in classes.orderBy(F.desc(n)).limit(most).toLocalIterator():
        room -= row["count"]
        if room < 0:
            break
        least = row[n]
    return least


def frequent_words(vocabulary: DataFrame, most: int) -> dict[bytes, int]:
    """The words counted most often, ``most`` at most."""
    least = least_count(vocabulary, most)
    if least is None:
        return {}
    found = vocabulary.filter(F.col("n") >= least).toArrow()
    return dict(zip(found["word"].to_pylist(), found["n"].to_pylist(), strict=True))


def frequent_costs(every: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams met most often, ``most`` at most, in order, and their costs."""
    least = least_count(every, most, "met")
    found = every.filter(F.col("met") >= least if least is not None else F.lit(False)).select("gram", "cost").toArrow()
    grams, cost = found["gram"].to_numpy().astype(np.uint64), found["cost"].to_numpy().astype(np.float32)
    order = np.argsort(grams)
    return grams[order], cost[order]


def score(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
    frequent_grams: int = FREQUENT_GRAMS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score, and bits_per_byte, the end being a byte."""
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    kind = docs.schema[key].dataType.simpleString()
    statistics = workspace.write(corpus_statistics(docs, text, held_out(F.col(key))), "statistics")
    summed, met = F.sum("n").alias("n"), F.sum("met").alias("met")
    grams = workspace.write(statistics.filter("gram IS NOT NULL").groupBy("gram").agg(summed, met), "grams")
    vocabulary = workspace.write(statistics.filter("word IS NOT NULL").groupBy("word").agg(summed), "vocabulary")
    every = gram_costs(grams, workspace)
    table = spark.sparkContext.broadcast(packed(frequent_costs(every, frequent_grams)))
    known = spark.sparkContext.broadcast(frequent_words(vocabulary, frequent))
    totals = vocabulary.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    ends = vocabulary.filter(F.col("word") == F.lit(b"")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    all_tokens = int(totals["n"])
    floor = float(np.log10(all_tokens + SMOOTHING * (totals["v"] + 1)))

    name = uuid.uuid4().hex

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        value = {word: float(np.log10(n + SMOOTHING)) for word, n in known.value.items()}
        memo = Memo.of(name, lambda: unpacked(table.value), listed)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data = [lowered(t) for t in batch["text"]]
            base, met, tokens, others = [], [], [], []
            for one in data:
                words = one.split()
                found = [v for v in map(value.get, words) if v is not None]
                base.append(sum(found) + float(np.log10(ends + SMOOTHING)) - floor * (len(found) + 1))
                met.append(len(found) + (ends > 0))
                tokens.append(len(words) + 1)
                others.append([w for w in words if w not in value] if len(found) < len(words) else [])
            bits = np.zeros(len(data))
            unlisted: list[list[np.ndarray]] = [[] for _ in data]
            for grams, owner, start in blocks(enumerate(data)):
                cost = memo(grams)
                missed = np.isnan(cost)
                if missed.any():
                    cost[missed] = 0
                    for one, first, end in zip(owner, start, [*start[1:], len(grams)], strict=True):
                        unlisted[one].append(grams[first:end][missed[first:end]].astype(np.int64))
                np.add.at(bits, owner, np.add.reduceat(cost, start))
            found = pd.DataFrame(
                {
                    "row": np.arange(row, row + len(data)),
                    "key": batch["key"],
                    "n_tokens": tokens,
                    "met": met,
                    "base": base,
                    "others": others,
                    "unlisted": [np.concatenate(u) if u else np.zeros(0, dtype=np.int64) for u in unlisted],
                    "bits": bits,
                    "n_bytes": [len(one) + 1 for one in data],
                }
            )
            yield objects(found)
            row += len(data)

    # Keys travel as text: a null among numbers would make pandas take them for floats.
    schema = "row long, key string, n_tokens long, met long, base double, others array<binary>, unlisted array<long>, bits double, n_bytes long"
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(scored, schema)
    rows = workspace.write(rows.withColumn("key", F.col("key").cast(kind)), "scored")
    rare = rows.select("row", F.explode("others").alias("word")).join(vocabulary, "word", "left")
    n = F.coalesce("n", F.lit(0))
    rest = rare.groupBy(F.col("row").alias("row_")).agg(
        F.sum(F.log10(n + SMOOTHING) - floor).alias("more"), F.sum((n > 0).cast("long")).alias("more_met")
    )
    few = rows.select("row", F.explode("unlisted").alias("gram")).join(every.select("gram", "cost"), "gram")
    rarest = few.groupBy(F.col("row").alias("row__")).agg(F.sum("cost").alias("more_bits"))
    joined = rows.drop("others", "unlisted").join(rest, F.col("row") == F.col("row_"), "left")
    joined = joined.join(rarest, F.col("row") == F.col("row__"), "left")
    cost = F.col("bits") + F.coalesce("more_bits", F.lit(0.0))
    return joined.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "n_tokens",
        (F.col("met") + F.coalesce("more_met", F.lit(0))).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (cost / float(np.log(10))).alias("score"),
        (-cost / float(np.log(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
