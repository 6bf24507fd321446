"""Benchmark items in documents, also with other numbers, names and units: windows of templates and consistent slots.

Words are reduced to templates: outer punctuation goes, letters become small, a number, a unit after a number and a name
(one capital at the start of a word inside a sentence) become placeholders of their kind. Windows of eight template words, five of them plain at
least, are joined by hash with the windows of the benchmark. What stood in the placeholders travels along as slot values.

A document holds an item if three of the item's windows (all, if it has fewer) stand in it and its slots are
filled consistently: at least four fifths of the slot values of the item have one and the same counterpart in the
document each time. That is judged over the document as a whole and for each occurrence (windows at one distance from
the item's); an occurrence alone counts if it holds all windows of the item or its values are those of the item, so parts of
several variants in one document do not. `kind` is `exact` if the counterparts are the values themselves, else `template`.

Items with fewer than three such windows (rich in numbers and names, short, or in a script without spaces) are also held
word by word: their literal windows, of eight words or as many as they have, are joined as they are, without placeholders,
and count as `exact`. A literal item under five words must stand as a line or sentence of its own. Characters of scripts
without spaces are words of their own; an item that is mostly of these needs half of its windows.

The benchmark's window hashes go to all tasks as one sorted array while there are at most `SENT_KEYS` of them (8 bytes
each), so only windows that occur in the benchmark leave a task. A larger benchmark is joined by shuffling the documents'
windows; the result is the same.

Cases: null and empty texts hold nothing; an item of five to seven words is one window of its own length, as a template with
at most two placeholders; shorter items, and items of placeholders alone, are found word by word only; an item of a single
word cannot be told from chance and is never found; items with equal templates and slots count as the one with the smallest id; repeated rows count as one document; documents
without an id are reported under a null id and stay in `remove_leaks`; empty tables give empty results; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tables import sent_if_small, stored
from gaugeline.llm.words import chunks, constants, windows, word_hashes, words_of

SIZE, PLAIN, SHORTEST = 8, 5, 5
TEMPLATE, LITERAL = 0, 1
NEEDED = 3
CONSISTENT = 0.8
SENT_KEYS = 4_000_000
#: Units that may follow a number.
UNITS = ("kg g mg lb lbs pound pounds oz ounces ton tons tonnes km m cm mm mi mile miles meter meters metre metres foot feet ft inch inches yards "
         "l ml liter liters litre litres gallon gallons h hr hrs hour hours min mins minute minutes s sec secs second seconds ms day days week weeks "
         "month months year years percent dollar dollars cent cents euro euros usd eur km/h mph kmh degrees celsius fahrenheit hz khz mhz ghz "
         "kb mb gb tb w kw v a j kj cal kcal n pa bar mol").split()

_NUMBER, _NAME, _UNIT, _LITERAL = constants(4, 31)
_CORE = np.zeros(256, bool)
_CORE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def _lowered(data: np.ndarray) -> np.ndarray:
    """Small letters for the capitals of ASCII and Latin-1."""
    out = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    second = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[second] += 32
    return out


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of characters of scripts without spaces (kana, Han; Thai, Lao; Burmese; Khmer), and of their punctuation."""
    one, two = (np.append(data, np.zeros(k, np.uint8))[k:] for k in (1, 2))
    marks = (data == 0xE3) & (one == 0x80)
    han = ((data >= 0xE3) & (data <= 0xE9)) & ~marks
    south = (data == 0xE0) & (one >= 0xB8) & (one <= 0xBB)
    south |= (data == 0xE1) & (((one >= 0x80) & (one <= 0x81)) | ((one == 0x82) & (two < 0xA0)) | (one == 0x9E) | (one == 0x9F))
    return np.flatnonzero(han | south), np.flatnonzero(marks)


_UNIT_HASHES = np.unique(words_of(pa.array(UNITS)).hash)


class Template:
    """Template words of texts: `hash` with placeholders, `value` without, `plain`, `text` (number of the text)."""

    def __init__(self, texts: pa.Array):
        words = words_of(texts)
        data = words.data
        own, marks = _characters(data)
        single = np.zeros(len(data) + 1, bool)
        single[own] = True
        if len(own) or len(marks):
            # each such character is a word, and ends the one before it; marks end a sentence and are no words
            alone = np.concatenate([own, marks])
            start, end = np.union1d(words.start, np.concatenate([alone, alone + 3])), np.union1d(words.end, np.concatenate([alone, alone + 3]))
            start = start[np.isin(start, words.end, invert=True) | np.isin(start, words.start)]
            end = end[np.isin(end, words.start, invert=True) | np.isin(end, words.end)]
            text = words.text[np.searchsorted(words.start, start, side="right") - 1]
            inside = np.isin(start, marks, invert=True)
            words.start, words.end, words.text = start[inside], end[inside], text[inside]
        core = _CORE[data]
        n = len(data)
        index = np.arange(n)
        # first core byte at or after, last core byte at or before each byte
        after = np.minimum.accumulate(np.where(core, index, n)[::-1])[::-1] if n else index
        before = np.maximum.accumulate(np.where(core, index, -1)) if n else index
        start = after[words.start] if n else words.start
        end = before[words.end - 1] + 1 if n else words.end
        real = start < words.end
        ends_sentence = _ENDS[data[words.end - 1]] if n else real
        opens = np.ones(len(real), bool)
        opens[1:] = ends_sentence[:-1] | (words.text[1:] != words.text[:-1])
        lines = np.cumsum(data == 10)
        opens[1:] |= lines[words.start[1:]] != lines[words.start[:-1]] if n else False
        raw_end = words.end[real]
        start, end, opens, self.text = start[real], end[real], opens[real], words.text[real]
        self.single = single[start]
        # a sentence or line ends after a word: at the end of its text, by a mark behind the word, by a new line before the next
        stops = np.append(0, np.cumsum(_ENDS[data]))
        self.closes = np.ones(len(start), bool)
        self.closes[:-1] = (stops[raw_end] > stops[end])[:-1] | (self.text[1:] != self.text[:-1])
        if n and len(start):
            self.closes[:-1] |= lines[start[1:]] != lines[end[:-1] - 1]
            if len(marks):
                self.closes[:-1] |= np.searchsorted(marks, start[1:]) != np.searchsorted(marks, end[:-1])
        self.begins = np.append(True, self.closes[:-1])[: len(start)]
        small = _lowered(data)
        self.value = word_hashes(small, start, end)
        digits = np.append(0, np.cumsum((data >= 48) & (data <= 57)))
        first = data[start]
        number = (first >= 48) & (first <= 57) & (digits[end] > digits[start])
        capital = (small[start] != first) | ((first == 0xC3) & (small[np.minimum(start + 1, max(n - 1, 0))] != data[np.minimum(start + 1, max(n - 1, 0))]))
        second = np.minimum(start + np.where(first == 0xC3, 2, 1), max(n - 1, 0))
        # words in capitals throughout, and single capitals, are no names: their text may be set in capitals
        name = capital & ~opens & (second < end) & (small[second] == data[second])
        unit = np.zeros(len(start), bool)
        unit[1:] = number[:-1] & (self.text[1:] == self.text[:-1]) & np.isin(self.value[1:], _UNIT_HASHES)
        self.hash = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, self.value)))
        self.plain = ~(number | unit | name)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of windows within a text that have enough plain words."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        plain = np.append(0, np.cumsum(self.plain))
        enough = plain[size:] - plain[:n] >= (PLAIN if size == SIZE else size - 2)
        at = np.flatnonzero(enough & (self.text[:n] == self.text[size - 1:]))
        return at, (windows(self.hash, size) + np.uint64(size))[at]

    def literal_windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of windows of words as they are; short ones are whole sentences or lines."""
        n = len(self.value) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        fits = self.text[:n] == self.text[size - 1:]
        if size < SHORTEST:
            fits &= self.begins[:n] & self.closes[size - 1:]
        at = np.flatnonzero(fits)
        return at, (windows(self.value, size) * _LITERAL + np.uint64(size))[at]

    def slots(self, at: np.ndarray, size: int) -> pa.Array:
        spots = at[:, None] + np.arange(size)
        filled = ~self.plain[spots]
        edges = np.append(0, np.cumsum(filled.sum(axis=1))).astype(np.int32)
        return pa.ListArray.from_arrays(edges, pa.array(self.value[spots][filled].view(np.int64)))


def _rows(part: pa.RecordBatch, template: Template, at: np.ndarray, key: np.ndarray, size: int, mode: int) -> pa.RecordBatch:
    slots = template.slots(at, size) if mode == TEMPLATE else pa.array([[]] * len(at), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [part.column(0).take(pa.array(template.text[at])), pa.array(key.view(np.int64)), pa.array(at), slots],
        names=["id", "key", "at", "slots"])


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """id, key, at (place), slots, size, mode, single (of characters) of each window of each item; items that are equal count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                template = Template(part.column(1))
                length = np.bincount(template.text, minlength=part.num_rows)
                n_found = np.zeros(part.num_rows, np.int64)
                for mode in (TEMPLATE, LITERAL):
                    for size in range(SHORTEST if mode == TEMPLATE else 2, SIZE + 1):
                        at, hashed = template.windows(size) if mode == TEMPLATE else template.literal_windows(size)
                        text = template.text[at]
                        own = (length[text] == size) | ((size == SIZE) & (length[text] > size))
                        if mode == TEMPLATE:
                            n_found += np.bincount(text[own], minlength=part.num_rows)
                        elif size < SHORTEST:  # the whole item, whatever sentences it has
                            first = np.searchsorted(template.text, np.flatnonzero(length == size))
                            hashed, at = (windows(template.value, size) * _LITERAL + np.uint64(size))[first], first
                            own = np.ones(len(at), bool)
                        else:
                            own &= n_found[text] < NEEDED
                        rows = _rows(part, template, at[own], hashed[own], size, mode)
                        single = template.single[at[own][:, None] + np.arange(size)].mean(axis=1) if rows.num_rows else np.zeros(0)
                        for name, value in (("size", np.full(rows.num_rows, size, np.int32)), ("mode", np.full(rows.num_rows, mode, np.int32)),
                                            ("single", single)):
                            rows = rows.append_column(name, pa.array(value))
                        yield rows

    kind = items.select(key).schema[0].dataType.simpleString()
    slim = items.select(F.col(key).alias("id"), F.col(text).alias("text"))
    found = slim.mapInArrow(run, f"id {kind}, key bigint, at bigint, slots array<bigint>, size int, mode int, single double")
    first = found.groupBy("id").agg(F.sum(F.xxhash64("key", "slots").bitwiseAND((1 << 40) - 1)).alias("one"), F.count(F.lit(1)).alias("n"))
    kept = first.groupBy("one", "n").agg(F.min("id").alias("id"))
    return found.join(kept.select("id"), "id", "left_semi")


def hits(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, copy (hash of the text), key, place and slots of the documents' windows whose key is known."""
    sizes = sorted(tuple(r) for r in known.select("mode", "size").distinct().collect())  # at most eleven
    keys = known.select("key").distinct()
    few = keys.limit(SENT_KEYS + 1).count() <= SENT_KEYS
    sent = np.sort(keys.toArrow().column(0).to_numpy().view(np.uint64)) if few else None
    sent = docs.sparkSession.sparkContext.broadcast(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for batch in batches:
            for part in chunks(batch, "text"):
                template = Template(part.column(1))
                for mode, size in sizes:
                    at, hashed = template.windows(size) if mode == TEMPLATE else template.literal_windows(size)
                    if wanted is not None:
                        found = wanted[np.minimum(np.searchsorted(wanted, hashed), len(wanted) - 1)] == hashed if len(wanted) else hashed < 0
                        at, hashed = at[found], hashed[found]
                    rows = _rows(part, template, at, hashed, size, mode)
                    yield rows.append_column("copy", part.column(2).take(pa.array(template.text[at])))

    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("copy"))
    found = slim.mapInArrow(run, f"id {kind}, key bigint, at bigint, slots array<bigint>, copy bigint")
    return found.select(F.col("id").alias("doc"), "copy", "key", F.col("at").alias("place"), "slots")


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """A row per document and item that it holds: key, item_key, n_windows, n_found, consistency, kind."""
    known = stored(item_windows(items, item_key, item_text), "item-windows")
    # an item that is found word by word is judged as an item of its own
    item = F.struct("id", "mode").alias("item")
    many = F.when(F.avg("single") > 0.5, F.greatest(F.lit(NEEDED), F.ceil(F.count(F.lit(1)) / 2))).otherwise(F.lit(NEEDED))
    total = known.groupBy(item).agg(F.count(F.lit(1)).alias("n_windows"), F.least(many, F.count(F.lit(1))).alias("needed"))
    pairs = hits(docs, known, key, text).join(known.select("key", item, "at", F.col("slots").alias("own")), "key")
    # an occurrence: windows at one distance from the item's, or, with words put in or left out, at distances that differ
    # by less than half of its windows; two grids hold each such range whole in one of them
    shift, half = F.col("place") - F.col("at"), F.greatest(F.ceil(F.col("n_windows") / 2), F.lit(1))
    occurrences = F.array(
        F.struct(F.lit(0).alias("way"), F.lit(0).cast("bigint").alias("copy"), F.lit(0).cast("bigint").alias("spot")),
        F.struct(F.lit(1).alias("way"), "copy", shift.cast("bigint").alias("spot")),
        *(F.struct(F.lit(way).alias("way"), "copy", F.floor((shift + more) / (2 * half)).cast("bigint").alias("spot"))
          for way, more in ((2, F.lit(0)), (3, half))))
    pairs = stored(pairs.join(total, "item").withColumn("seen", F.explode(occurrences)).drop("place", "copy"), "leak-windows")
    found = pairs.groupBy("doc", "item", "seen", "n_windows", "needed").agg(F.countDistinct("at").alias("n_found"))
    filled = pairs.select("doc", "item", "seen", F.explode(F.arrays_zip("own", "slots")).alias("s"))
    filled = filled.groupBy("doc", "item", "seen", F.col("s.own").alias("own"), F.col("s.slots").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    filled = filled.groupBy("doc", "item", "seen", "own").agg(F.max(F.struct("n", "slot")).alias("most"), F.sum("n").alias("n"))
    filled = filled.groupBy(F.col("doc").alias("d"), F.col("item").alias("i"), F.col("seen").alias("o")).agg(
        (F.sum("most.n") / F.sum("n")).alias("consistency"), F.min(F.col("most.slot") == F.col("own")).alias("same"))
    same_place = found["doc"].eqNullSafe(F.col("d")) & (found["item"] == F.col("i")) & (found["seen"] == F.col("o"))
    judged = found.join(filled, same_place, "left").withColumns(
        {"consistency": F.coalesce("consistency", F.lit(1.0)), "same": F.coalesce("same", F.lit(True))})
    whole = (F.col("seen.way") == 0) | F.col("same") | (F.col("n_found") == F.col("n_windows"))
    judged = judged.filter(whole & (F.col("n_found") >= F.col("needed")) & (F.col("consistency") >= CONSISTENT))
    best = judged.groupBy("doc", F.col("item.id").alias("item")).agg(
        F.max(F.struct("item.mode", "n_found", "same", "consistency", "n_windows")).alias("best"))
    kind = F.when(F.col("best.same"), "exact").otherwise("template")
    return best.select(F.col("doc").alias(key), F.col("item").alias(item_key), F.col("best.n_windows").alias("n_windows"),
                       F.col("best.n_found").alias("n_found"), F.col("best.consistency").alias("consistency"), kind.alias("kind"))


def remove_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    held = sent_if_small(leaks(docs, items, key, text, item_key, item_text).select(key).distinct(), "leaking")
    return docs.join(held, key, "left_anti").select(*docs.columns)
