"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes a stream of lower-cased letters with one blank for every run of anything else; its n-grams
of 1 to 4 characters, blanks included, are hashed into ``BUCKETS``. Training counts n-grams per language over
all labelled training documents: tasks add up what they read, one sum per (language, bucket) follows. The
log-probabilities, a matrix of buckets by languages, are broadcast; scoring sums the rows that a text's n-grams
select, in numpy, a batch of texts at a time.

How it scales. What reaches the driver is at most ``BUCKETS`` times the number of languages, whatever the
number of documents; more than ``MOST_LANGUAGES`` languages raise an error instead of growing the broadcast. Tasks read
texts in slices, so that a very long text costs time, not memory. No shuffle carries text.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if nothing was learned; ties go
to the language that sorts first. The score is the posterior probability of the predicted language, tempered by the
number of n-grams so that it does not merely say 1 for every longer text. Rows are decided on their own, repeated
ones alike; null keys belong to the training part or not as the empty text does. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import objects, per_process, remainder

BUCKETS = 1 << 16
ORDERS = 4
MOST_LANGUAGES = 512
SMOOTHING = 0.5
UNKNOWN = "und"

# Characters handled in one numpy step.
SLICE = 1 << 17

# Beyond this code point there are no letters.
LAST_LETTER = 0x34000


def letter_table() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else a blank."""
    return per_process("letters", _letter_table)


def _letter_table() -> np.ndarray:
    table = np.full(0x110000, 32, dtype=np.uint32)
    characters = [chr(point) for point in range(LAST_LETTER)]
    is_letter = np.fromiter(map(str.isalpha, characters), dtype=bool, count=LAST_LETTER)
    for point in np.flatnonzero(is_letter):
        low = characters[point].lower()
        table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str) -> np.ndarray:
    """Code points of the stream: blank, letters, single blanks, a blank at the end; empty without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    stream = letter_table()[points]
    blank = stream == 32
    if blank.all():
        return stream[:0]
    keep = np.empty(len(stream), dtype=bool)
    keep[0] = True
    keep[1:] = ~(blank[1:] & blank[:-1])
    parts = [stream[keep]]
    if not blank[0]:
        parts.insert(0, np.array([32], dtype=np.uint32))
    if not blank[-1]:
        parts.append(np.array([32], dtype=np.uint32))
    return np.concatenate(parts)


def grams(stream: np.ndarray, orders: int = ORDERS, buckets: int = BUCKETS) -> list[np.ndarray]:
    """Bucket of every n-gram, one array per order; the n-gram at i ends with character i."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    code = stream.astype(np.uint64)
    result = []
    hashed = np.zeros(len(code), dtype=np.uint64)
    for order in range(1, orders + 1):
        if order > len(code):
            break
        # Extends each n-gram by the character before it.
        hashed = (hashed[-(len(code) - order + 1) :] if order > 1 else hashed) * np.uint64(0x9E3779B97F4A7C15)
        hashed = hashed + (code[: len(code) - order + 1] + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        result.append((mixed >> shift).astype(np.int64))
    return result


def sliced(text: str, most: int | None = None) -> Iterator[str]:
    """Parts of about ``most`` characters that end beside a character that is no letter, so that every word is whole.

    A run of letters longer than that is a part of its own length.
    """
    most, table, start = most or SLICE, letter_table(), 0

    def inside_a_word(at: int) -> bool:
        return 0 < at < len(text) and table[ord(text[at - 1])] != 32 and table[ord(text[at])] != 32

    while start < len(text):
        end = start + most
        while end > start and inside_a_word(end):
            end -= 1
        if end == start:
            end = start + most
            while inside_a_word(end):
                end += 1
        yield text[start:end]
        start = end


def count_grams(docs: DataFrame, *, text: str, lang: str) -> DataFrame:
    """``lang``, ``bucket``, ``n`` over all rows; each task adds up its own before anything is sent."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for value, name in zip(batch["text"], batch["lang"], strict=True):
                total = sums.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                seen[name] = seen.get(name, 0) + 1
                for part in sliced(value or ""):
                    found = grams(letters(part))
                    if found:
                        total += np.bincount(np.concatenate(found), minlength=BUCKETS)
        for name, total in sums.items():
            used = np.flatnonzero(total)
            names = np.full(len(used), name, dtype=object)
            yield pd.DataFrame({"lang": names, "bucket": used.astype(np.int32), "n": total[used]})
            yield objects(pd.DataFrame({"lang": [name], "bucket": np.array([-1], dtype=np.int32), "n": [seen[name]]}))

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.mapInPandas(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, log-probabilities (language, bucket) and log-priors, from rows with a language."""
    labelled = docs.filter(F.col(lang).isNotNull())
    names = [r[0] for r in labelled.select(lang).distinct().orderBy(lang).limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(names), BUCKETS))
    documents = np.ones(len(names))
    place = {name: i for i, name in enumerate(names)}
    if names:
        found = count_grams(labelled, text=text, lang=lang).toArrow().to_pandas()
        column = found["lang"].map(place).to_numpy()
        bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
        is_prior = bucket < 0
        documents[column[is_prior]] = n[is_prior]
        counts[column[~is_prior], bucket[~is_prior]] = n[~is_prior]
    counts += SMOOTHING
    chance = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return names, chance.astype(np.float32), np.log(documents) - np.log(documents.sum())


def score_texts(texts: list[str | None], chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log-probabilities per text and language, and the number of n-grams, texts joined in batches."""
    sums = np.zeros((len(texts), len(chance)))
    sizes = np.zeros(len(texts), dtype=np.int64)
    streams, owners, held = [], [], 0

    def flush() -> None:
        # The texts of a batch form one stream; sums stop short of the n-grams that reach into the next text.
        nonlocal held
        if not streams:
            return
        own = np.array(owners)
        lengths = np.array([len(s) for s in streams])
        first = np.cumsum(lengths) - lengths
        for order, buckets in enumerate(grams(np.concatenate(streams))):
            whole = lengths > order
            bounds = np.stack([first[whole], (first + lengths - order)[whole]], axis=1).ravel()
            # reduceat takes no bound at the end of the data; the last sum then runs to the end, as it should.
            bounds = bounds[:-1] if len(bounds) and bounds[-1] >= len(buckets) else bounds
            if not len(bounds):
                continue
            for language, row in enumerate(chance):
                part = np.add.reduceat(row.take(buckets), bounds, dtype=np.float64)[::2]
                np.add.at(sums[:, language], own[whole], part)
            np.add.at(sizes, own[whole], (lengths - order)[whole])
        streams.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        for part in sliced(text or ""):
            stream = letters(part)
            if len(stream):
                streams.append(stream)
                owners.append(i)
                held += len(stream)
            if held >= SLICE:
                flush()
    flush()
    return sums, sizes


def predict(docs: DataFrame, model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row; only the text is looked at."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, chance, prior = sent.value
        for batch in batches:
            labels = np.full(len(batch), UNKNOWN, dtype=object)
            scores = np.zeros(len(batch))
            if names:
                sums, sizes = score_texts(list(batch["text"]), chance)
                logs = (sums + prior) / np.sqrt(np.maximum(sizes, 1))[:, None]
                share = np.exp(logs - logs.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                best = share.argmax(axis=1)
                known = sizes > 0
                labels[known] = np.array(names, dtype=object)[best[known]]
                scores[known] = share[np.arange(len(best)), best][known]
            yield objects(pd.DataFrame({"key": batch["key"], "lang_pred": labels, "score": scores}))

    # Keys travel as text: a null among numbers would make pandas take them for floats.
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    found = rows.mapInPandas(predicted, "key string, lang_pred string, score double")
    return found.select(F.col("key").cast(kind).alias(key), "lang_pred", "score")


def held_out(key: Column) -> Column:
    """Is a document kept out of training?"""
    return remainder(key, 3) == 1


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: key, ``held_out``, ``lang_pred``, ``score``; learned from the documents not held out."""
    model = train(docs.filter(~held_out(F.col(key))), text=text, lang=lang)
    found = predict(docs, model, key=key, text=text)
    return found.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")
