"""Benchmark decontamination by Wu-Manber search for windows of item words.

A window is ``SIZE`` consecutive words of an item, or all words of a shorter one. Windows are byte strings, words joined by
one blank, and so is every document; a window occurs where its bytes do and the bytes around it belong to no word.

The search. A block of bytes is hashed into a shift table, which says how far the nearest window is that could
hold it; positions in between are never looked at. Where the shift is zero, the block's bucket names the windows that end
there (their first ``m`` bytes, ``m`` being the shortest length), whose first bytes and then whole strings are
compared. Short windows would make every shift short, so windows are searched in bands of similar length. All segments of
a chunk of texts are scanned in step, each by its own cursor.

How it scales. Windows are cut and merged in Spark, each with the items it is from. They are dealt by hash to as
many sets as keep each below ``SET_BYTES``; a set's tables are broadcast, so their size does not grow with the
benchmark. One set, the usual case, needs one scan of the documents and no shuffle. More sets take a scan each, which
return the hit documents only, merged by (key, digest of the text). Texts are handled whole, in chunks of at
least one text; any document's work depends on nothing but its own words and the windows it holds.

Defined results: a null or empty text has no words, no hits and the digest of the empty list; a null or empty item has no
windows; items without id count as the empty id; rows of one id are one item with the windows of each. Repeated
documents are answered alike, once per row; a window that occurs twice counts its words once. An empty benchmark hits
nothing, an empty table of documents gives no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace

SIZE = 10
SET_BYTES = 16 << 20
CHUNK_BYTES = 4 << 20
# Lengths at which a new band of windows begins.
BANDS = (1, 8, 16, 32, 64)
SEGMENTS = 8192
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
PAD = bytes(8)
BLANK, END = 32, 10

# Bytes of words, that is digits, letters and all beyond ASCII, after lower-casing A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def byte_table() -> np.ndarray:
    """What each byte becomes: lower case, and a blank if no word holds it."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    in_word = (table >= 0x80) | ((table >= ord("0")) & (table <= ord("9"))) | ((table >= ord("a")) & (table <= ord("z")))
    return np.where(in_word, table, BLANK).astype(np.uint8)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, GAP), "")


def windows(items: DataFrame, *, key: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``window`` and the sorted ids ``items`` that hold it, each once."""
    words = items.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("words")
    ).filter(F.size("words") > 0)
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))))
    cut = words.select("item", "words", first.alias("first")).select(
        "item", F.array_join(F.slice("words", F.col("first"), size), " ").alias("window")
    )
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def overlapping(data: bytes) -> np.ndarray:
    """Eight bytes from each place of ``data`` on, as one number, the first byte being the lowest."""
    return np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))


def compiled(texts: Sequence[bytes]) -> dict:
    """Shift tables and buckets of the bands of ``texts``, which are distinct and not empty."""
    data = PAD + b"".join(texts) + PAD
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = len(PAD) + np.cumsum(lengths) - lengths
    eight = overlapping(data)
    bands = []
    which = np.searchsorted(BANDS, lengths, side="right")
    for band in np.unique(which):
        members = np.flatnonzero(which == band)
        shortest = int(lengths[members].min())
        block = max(1, min(8, shortest // 2))
        low = np.uint64(64 - 8 * block)
        bits = int(np.clip(np.ceil(np.log2(16 * len(members) * shortest)), 12, 24))
        shifts = np.full(1 << bits, min(shortest - block + 1, 65535), dtype=np.uint16)
        # From the left: a later occurrence of a block leaves the shorter shift.
        for end in range(block, shortest + 1):
            values = eight[starts[members] + end - 8] >> low
            shifts[slot(values, bits)] = min(shortest - end, 65535)
        order = np.argsort(values, kind="stable")
        head = np.uint64((1 << 8 * min(8, shortest)) - 1)
        bands.append(
            {
                "shortest": shortest,
                "low": low,
                "bits": bits,
                "shifts": shifts,
                "suffixes": values[order],
                "members": members[order],
                "head_mask": head,
                "heads": (eight[starts[members]] & head)[order],
            }
        )
    return {"data": data, "starts": starts, "lengths": lengths, "bands": bands}


def slot(values: np.ndarray, bits: int) -> np.ndarray:
    return (values * MULTIPLIER) >> np.uint64(64 - bits)


def candidates(band: dict, eight: np.ndarray, n: int) -> np.ndarray:
    """Ends of the places at which the shift is zero, of a text of ``n`` bytes between pads."""
    first, last = len(PAD) + band["shortest"], len(PAD) + n
    if first > last:
        return np.zeros(0, dtype=np.int64)
    step = max(16 * band["shortest"], -(-(last - first + 1) // SEGMENTS))
    at = np.arange(first, last + 1, step)
    limit = np.minimum(at + step - 1, last)
    found = []
    while len(at):
        shift = band["shifts"][slot(eight[at - 8] >> band["low"], band["bits"])]
        found.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        going = at <= limit
        at, limit = at[going], limit[going]
    return np.concatenate(found)


def occurrences(tables: dict, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and windows (numbers) of all occurrences in ``text``, normalized bytes that begin and end with ``END``."""
    padded = PAD + text + PAD
    flat, eight = np.frombuffer(padded, dtype=np.uint8), overlapping(padded)
    places, found = [], []
    for band in tables["bands"]:
        ends = candidates(band, eight, len(text))
        suffix = eight[ends - 8] >> band["low"]
        low = np.searchsorted(band["suffixes"], suffix)
        count = np.searchsorted(band["suffixes"], suffix, side="right") - low
        start = np.repeat(ends - band["shortest"], count)
        # Members of each end's bucket, one after the other.
        member = np.arange(len(start)) - np.repeat(np.cumsum(count) - count - low, count)
        alike = (eight[start] & band["head_mask"]) == band["heads"][member]
        start, window = start[alike], band["members"][member[alike]]
        after = start + tables["lengths"][window]
        inside = after < len(padded)
        start, window, after = start[inside], window[inside], after[inside]
        whole = (flat[start - 1] <= BLANK) & (flat[after] <= BLANK)
        for at, number in zip(start[whole].tolist(), window[whole].tolist(), strict=True):
            begin = tables["starts"][number]
            if padded.startswith(tables["data"][begin : begin + tables["lengths"][number]], at):
                places.append(at - len(PAD))
                found.append(number)
    return np.array(places, dtype=np.int64), np.array(found, dtype=np.int64)


def normalized(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Texts cut at ``offsets`` as words parted by one blank each, with ``END`` before every text and at the end."""
    plain = table[data[offsets[0] : offsets[-1]]]
    plain = np.insert(plain, offsets - offsets[0], END)
    in_word = plain > BLANK
    keep = in_word | (plain == END)
    keep[1:] |= in_word[:-1]
    return plain[keep]


def _hits(tables: dict, sizes: np.ndarray, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Words of each text, and of all occurrences the text, the first word in it, the words and the window."""
    plain = normalized(data, offsets, table)
    in_word = plain > BLANK
    words = np.flatnonzero(in_word[1:] & ~in_word[:-1]) + 1
    bounds = np.searchsorted(words, np.flatnonzero(plain == END))
    places, found = occurrences(tables, plain.tobytes())
    first = np.searchsorted(words, places)
    text = np.searchsorted(bounds, first, side="right") - 1
    return np.diff(bounds), text, first - bounds[text], sizes[found], found


def covered(first: np.ndarray, n: np.ndarray) -> int:
    """Words below the union of spans."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], (first + n)[order]
    reach = np.maximum.accumulate(last)
    before = np.concatenate([[0], reach[:-1]])
    return int(np.maximum(0, reach - np.maximum(first, before)).sum())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes of their texts (second column) and the texts' offsets in them."""
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else [0]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        start = 0
        while start < len(texts):
            end = int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, side="right")) - 1
            end = max(start + 1, min(end, len(texts)))
            yield batch.slice(start, end - start), data, offsets[start : end + 1]
            start = end


def _groups(text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Texts that occur in ``text``, each with its places."""
    order = np.argsort(text, kind="stable")
    if len(order):
        for part in np.split(order, np.flatnonzero(np.diff(text[order])) + 1):
            yield int(text[part[0]]), part


def digest(items: Sequence[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _report(broadcast):
    """Whole answers, where one set holds all windows."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sizes, items = broadcast.value
        table, nothing, known = byte_table(), digest([]), {}
        for rows, data, offsets in _chunks(batches):
            n_words, text, first, n, found = _hits(tables, sizes, data, offsets, table)
            n_hit, n_items = np.zeros(len(n_words), dtype=np.int64), np.zeros(len(n_words), dtype=np.int64)
            digests = [nothing] * len(n_words)
            known.clear()
            for row, part in _groups(text):
                n_hit[row] = covered(first[part], n[part])
                distinct = np.unique(found[part])
                name = distinct.tobytes()
                if name not in known:
                    ids = sorted({i for w in distinct.tolist() for i in items[w]})
                    known[name] = len(ids), digest(ids)
                n_items[row], digests[row] = known[name]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n_words), pa.array(n_hit), pa.array(n_items), pa.array(digests), pa.array(n_hit > 0)],
                names=["key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return report


def _partial(broadcast):
    """Spans and items of the hit texts, where this set holds some of the windows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sizes, items = broadcast.value
        table = byte_table()
        for rows, data, offsets in _chunks(batches):
            _, text, first, n, found = _hits(tables, sizes, data, offsets, table)
            hit, spans, ids = [], [], []
            for row, part in _groups(text):
                hit.append(row)
                spans.append([{"first": a, "n": b} for a, b in zip(first[part].tolist(), n[part].tolist(), strict=True)])
                ids.append(sorted({i for w in np.unique(found[part]).tolist() for i in items[w]}))
            chosen = rows.take(pa.array(hit, type=pa.int64()))
            kinds = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())])), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [chosen.column(0), chosen.column(2), pa.array(spans, kinds[0]), pa.array(ids, kinds[1])],
                names=["key", "mark", "spans", "items"],
            )

    return partial


def _merged(docs: DataFrame, sets: list[DataFrame]) -> DataFrame:
    """Answers from the partial ones of several sets of windows."""
    hits = sets[0]
    for more in sets[1:]:
        hits = hits.unionAll(more)
    gathered = hits.groupBy("key", "mark").agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )

    def add(state: Column, span: Column) -> Column:
        last = span["first"] + span["n"]
        new = F.greatest(last - F.greatest(span["first"], state["reach"]), F.lit(0))
        return F.struct(F.greatest(state["reach"], last).alias("reach"), (state["n"] + new).alias("n"))

    zero = F.lit(0).cast("long")
    n_hit = F.aggregate("spans", F.struct(zero.alias("reach"), zero.alias("n")), add, lambda s: s["n"])
    # Repeated rows are counted first, so that a hot one is one row of the join.
    rows = docs.groupBy("key", "mark").agg(
        F.count("*").alias("rows"), F.first(F.size(words_of(F.col("text"))).cast("long")).alias("n_words")
    )
    same = rows["key"].eqNullSafe(gathered["key"]) & (rows["mark"] == gathered["mark"])
    joined = rows.join(gathered, same, "left").select(rows["key"].alias("key"), "rows", "n_words", "spans", "items")
    answered = joined.select(
        "key",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_copy"),
        "n_words",
        F.coalesce(n_hit, zero).alias("n_hit"),
        F.coalesce(F.size("items").cast("long"), zero).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
    )
    return answered.drop("_copy").withColumn("contaminated", F.col("n_hit") > 0)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    set_bytes: int = SET_BYTES,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per document: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    known = workspace.write(windows(items, key=item_key, text=item_text, size=size), "windows")
    # A window costs its bytes, its ids and some tens of bytes in tables.
    cost = F.octet_length("window") + 64 + F.aggregate("items", F.lit(0).cast("long"), lambda n, i: n + 16 + F.octet_length(i))
    total = known.agg(F.sum(cost)).first()[0] or 0
    n_sets = max(1, -(-int(total) // set_bytes))
    dealt = known.withColumn("set", F.pmod(F.xxhash64("window"), F.lit(n_sets)))

    def tables(number: int):
        rows = dealt.filter(F.col("set") == number).select("window", "items").collect()
        texts = [r["window"].encode() for r in rows]
        sizes = np.array([t.count(b" ") + 1 for t in texts], dtype=np.int64)
        return spark.sparkContext.broadcast((compiled(texts), sizes, [r["items"] for r in rows]))

    carried = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    if n_sets == 1:
        schema = f"key {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
        answered = carried.mapInArrow(_report(tables(0)), schema)
    else:
        marked = carried.withColumn("mark", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
        schema = f"key {kind}, mark binary, spans array<struct<first:long,n:long>>, items array<string>"
        sets = []
        for number in range(n_sets):
            held = tables(number)
            sets.append(workspace.write(marked.mapInArrow(_partial(held), schema), f"hits-{number}"))
            held.unpersist()
        answered = _merged(marked, sets)
    return answered.withColumnRenamed("key", key)
