"""Benchmark decontamination by template windows.

Texts are canonicalised word by word: numbers, names and units become typed
placeholders, other words their lower-case core without surrounding punctuation.
Windows of five template words are hash-joined with the benchmark's. A question that
was re-parameterised keeps its windows but not its values; the slot check then asks
that along one alignment every value of the item stands for one value of the document.
Windows with names are made a second time with the names as plain words, so that a copy
in another letter case, where names cannot be told from words, keeps them. New names in
lower case are not recognised.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from demandtide.llm.storage import stored
from demandtide.llm.words import batch, mix, shingles, shingles_at

#: Fixed list of unit words; a unit is one of these right after a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl dl l s sec secs min mins h hr hrs ms kb mb gb tb hz khz mhz ghz w kw mw kwh v a j kj cal kcal "
    "percent dollars dollar euros euro pounds pound cents cent meters meter metres metre kilometers kilometer kilometres kilometre centimeters centimeter "
    "miles mile feet foot inches inch yards yard grams gram kilograms kilogram tons ton liters liter litres litre seconds second minutes minute hours hour "
    "days day weeks week months month years year degrees degree".split()
)
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
_ATTACHED = re.compile(r"([+-]?\d[\d.,]*)([a-z]{1,4})", re.I)
LITERAL, NUMBER, UNIT, CAPITAL, NOTHING, PAIR = range(6)
_ENDS = 8
_MARKS = np.array([xxhash.xxh3_64_intdigest(b"<" + n + b">") for n in (b"literal", b"number", b"unit", b"name")], np.uint64)
_EXACT = np.uint64(0x5851F42D4C957F2D)


class Canonical(dict):
    """raw word -> number of its entry; the entry's hash, value and mark (its kind, and 8 more if it ends a sentence) stand in arrays."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit
        self._reset()

    def _reset(self):
        self.clear()
        self.values: list[str] = []
        self.pairs: dict[int, tuple[int, int]] = {}
        self.mark, self.hash = np.zeros(1024, np.uint8), np.zeros(1024, np.uint64)

    def _entry(self, kind: int, value: str, ends: bool) -> int:
        k = len(self.values)
        if k >= len(self.mark):
            self.mark, self.hash = (np.concatenate((x, np.zeros_like(x))) for x in (self.mark, self.hash))
        self.values.append(value)
        self.mark[k], self.hash[k] = kind + _ENDS * ends, xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass"))
        return k

    def __missing__(self, raw: str) -> int:
        lo, hi = 0, len(raw)
        while lo < hi and not raw[lo].isalnum():
            lo += 1
        while hi > lo and not raw[hi - 1].isalnum():
            hi -= 1
        core, ends = raw[lo:hi], any(c in ".!?" for c in raw[hi:])
        low = core.lower()
        if not core:
            k = self._entry(NOTHING, "", any(c in ".!?" for c in raw))
        elif _NUMBER.fullmatch(core):
            k = self._entry(NUMBER, low, ends)
        elif (m := _ATTACHED.fullmatch(core)) and m[2].lower() in UNITS:
            k = self._entry(PAIR, low, ends)
            self.pairs[k] = self._entry(NUMBER, m[1], False), self._entry(UNIT, m[2].lower(), ends)
        elif low in UNITS:
            k = self._entry(UNIT, low, ends)
        elif len(core) > 1 and core[0].isupper() and core[1:].islower():
            k = self._entry(CAPITAL, low, ends)
        else:
            k = self._entry(LITERAL, low, ends)
        self[raw] = k
        return k

    def words(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(entries, slots) of a text's words; a slot is 1 for a number, 2 for a unit, 3 for a name, 0 for none."""
        if len(self) > self.limit:
            self._reset()
        raw = text.split() if text else []
        at = np.fromiter(map(self.__getitem__, raw), np.int32, len(raw))
        mark = self.mark[at]
        odd = mark & 7
        if (odd == PAIR).any():
            at = np.fromiter((k for e in at.tolist() for k in self.pairs.get(e, (e,))), np.int32)
            mark = self.mark[at]
            odd = mark & 7
        if (odd == NOTHING).any():
            at = at[odd != NOTHING]
            mark = self.mark[at]
        slot = np.zeros(len(at), np.uint8)
        if len(at):
            kind = mark & 7
            slot[kind == NUMBER] = 1
            slot[1:][(kind[1:] == UNIT) & (kind[:-1] == NUMBER)] = 2
            slot[1:][(kind[1:] == CAPITAL) & (mark[:-1] < _ENDS)] = 3
        return at, slot

    def windows(self, text: str | None, n: int, either_first: bool = False) -> tuple[np.ndarray, list[tuple]]:
        """(entries, forms) of all windows of ``n`` words; a form has its windows' starts, hashes and readings, and marks of the slots
        among all words and of the windows that keep their values, which are those with under two literal words.

        The first form holds all windows. Those with names come again with the names as
        literal words and, if ``either_first``, the first one with its first word as a name.
        Readings are 1 with names as names, 2 with names as words, 0 without names, which is both.
        """
        at, slot = self.words(text)
        if len(at) < n:
            return at, []
        values = self.hash[at]
        names, named = slot == 3, np.zeros(len(at) - n + 1, np.int8)
        if names.any():
            count = np.concatenate(([0], np.cumsum(names)))
            named[count[n:] > count[:-n]] = 1
        forms = [self._form(values, slot, n, np.arange(len(named)), named)]
        if named.any():
            starts = np.flatnonzero(named)
            forms.append(self._form(values, np.where(names, 0, slot), n, starts, np.full(len(starts), 2, np.int8)))
        if either_first and self.mark[at[0]] & 7 == CAPITAL:
            forms.append(self._form(values, np.concatenate(([3], slot[1:])), n, np.zeros(1, np.int64), np.ones(1, np.int8)))
        return at, forms

    @staticmethod
    def _form(values: np.ndarray, slot: np.ndarray, n: int, starts: np.ndarray, reading: np.ndarray) -> tuple[np.ndarray, ...]:
        spots = np.flatnonzero(slot)
        template = values.copy()
        template[spots] = _MARKS[slot[spots]]
        out = shingles(template, n) if len(starts) == len(values) - n + 1 else shingles_at(template, n, starts)
        exact = np.zeros(len(out), bool)
        if len(spots):
            open_ = np.concatenate(([0], np.cumsum(slot > 0)))
            exact = n - (open_[starts + n] - open_[starts]) < min(2, n)
            kept = np.flatnonzero(exact)
            if len(kept):
                with np.errstate(over="ignore"):
                    out[kept] = mix(shingles_at(values, n, starts[kept]) + _EXACT)
        return starts, out, reading, slot > 0, exact


_ITEMS = pa.schema([("item_id", pa.int64()), ("width", pa.int32()), ("h", pa.int64()), ("at", pa.int64()), ("reading", pa.int8()), ("slots", pa.list_(pa.string()))])
_DOCS = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("at", pa.int64()), ("reading", pa.int8()), ("slots", pa.list_(pa.string()))])


def _values(table: Canonical, at: np.ndarray, slot: np.ndarray, p: int, n: int, exact: bool) -> list[str]:
    """Values of a window's slots; of all its words where its hash keeps them, as such windows meet whatever their slots are."""
    return [table.values[e] for e, s in zip(at[p : p + n].tolist(), slot[p : p + n].tolist()) if s or exact]


def _item_windows(n: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Canonical()
        for b in batches:
            for item, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                width = min(n, len(table.words(body)[0]))
                if width:
                    at, forms = table.windows(body, width, either_first=True)
                    for starts, h, reading, slot, exact in forms:
                        m = len(h)
                        slots = [_values(table, at, slot, p, width, e) for p, e in zip(starts.tolist(), exact.tolist())]
                        yield batch(_ITEMS, [item] * m, [width] * m, h.view(np.int64), starts, reading, slots)

    return make


def window_filter(windows: DataFrame, bits: int) -> np.ndarray:
    """Bit set of ``2 ** bits`` bits, as bytes, with two bits for every window hash ``h``; the executors join the bits, 64 a row."""
    probes = F.explode(F.array(*(F.shiftrightunsigned("h", k * bits).bitwiseAND(F.lit((1 << bits) - 1)) for k in (0, 1))))
    cells = windows.select(probes.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("mask"))
    met = cells.toPandas()  # at most 2 ** (bits - 6) rows, whatever the benchmark holds
    out = np.zeros(1 << (bits - 6), np.int64)
    out[met["cell"].to_numpy(np.int64)] = met["mask"].to_numpy(np.int64)
    return out.view(np.uint8)


def may_hold(known: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Places in ``h`` whose two bits are set: all hashes of the filter and few others."""
    hit = np.arange(len(h))
    for k in (0, 1):
        bit = h[hit] >> np.uint64(k * bits) & np.uint64((1 << bits) - 1)
        hit = hit[(known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1) > 0]
    return hit


def _document_windows(widths: list[int], known, bits: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wanted = Canonical(), known.value
        for b in batches:
            for doc, cell in zip(b.column(0).to_pylist(), b.column(1)):
                body = cell.as_py()
                for n in widths:
                    at, forms = table.windows(body, n)
                    for starts, h, reading, slot, exact in forms:
                        hit = may_hold(wanted, bits, h)
                        if not len(hit):
                            continue
                        open_ = np.concatenate(([0], np.cumsum(slot)))
                        slotted = (open_[starts[hit] + n] > open_[starts[hit]]) | exact[hit]
                        plain, spots = np.unique(h[hit[~slotted]]), hit[slotted]
                        hashes = np.concatenate((plain, h[spots])).view(np.int64)
                        where = [None] * len(plain) + starts[spots].tolist()
                        slots = [[]] * len(plain) + [_values(table, at, slot, p, n, e) for p, e in zip(starts[spots].tolist(), exact[spots].tolist())]
                        yield batch(_DOCS, [doc] * len(hashes), hashes, where, [0] * len(plain) + reading[spots].tolist(), slots)

    return make


def contaminated(docs: DataFrame, items: DataFrame, least: float = 0.8, n: int = 5, key: str = "doc_id", text: str = "text", filter_bits: int = 27) -> DataFrame:
    """(id, item_id, coverage): items of which a document holds ``least`` or more of the template windows.

    Items (item_id, text) with fewer than ``n`` words are one window as a whole; items
    without words or without id match nothing, nor do null and empty texts. Rows that
    repeat a key are one document. A window without slots counts wherever it stands; one
    with slots counts on an alignment (equal distance between its places in document and
    item) whose values agree. Windows over names match as templates or, in any letter case,
    as words; the forms of a window are aligned apart, so that one cannot spoil the other. The benchmark's window hashes reach the tasks as a
    set of ``2 ** filter_bits`` bits (6 to 31; 16 MB as it stands), the same at every size: what passes it
    wrongly meets nothing in the join, so the number of bits changes the work and not the result.
    """
    bench = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("body")).filter("item_id is not null and body is not null")
    windows = stored(bench.mapInArrow(_item_windows(n), "item_id long, width int, h long, at long, reading byte, slots array<string>"), "item-windows")
    widths = sorted(r.width for r in windows.select("width").distinct().collect())
    sizes = windows.groupBy("item_id").agg(F.count_distinct("at").alias("windows"))
    known = docs.sparkSession.sparkContext.broadcast(window_filter(windows, filter_bits))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("body"))
    met = texts.mapInArrow(_document_windows(widths, known, filter_bits), "id long, h long, at long, reading byte, slots array<string>")
    met = stored(met, "document-windows")
    w = windows.select("item_id", "h", F.col("at").alias("item_at"), F.col("reading").alias("item_reading"), F.col("slots").alias("item_slots"))
    pairs = met.join(w, "h")
    plain = pairs.filter("at is null").select("id", "item_id", "item_at")
    views = F.filter(F.array(F.lit(1), F.lit(2)), lambda v: F.col("reading").isin(0, v) & F.col("item_reading").isin(0, v))
    aligned = pairs.filter("at is not null").select(
        "id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), F.explode(views).alias("view"), "item_at", F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("slots")
    )
    runs = aligned.groupBy("id", "item_id", "shift", "view").agg(F.collect_set("item_at").alias("item_ats"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    agree = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["i"])))
    slotted = runs.filter(agree).select("id", "item_id", F.explode("item_ats").alias("item_at"))
    covered = plain.unionByName(slotted).distinct().groupBy("id", "item_id").agg(F.count("*").alias("n"))
    return covered.join(sizes, "item_id").select("id", "item_id", (F.col("n") / F.col("windows")).alias("coverage")).filter(F.col("coverage") >= least)


def decontaminate(docs: DataFrame, items: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, contaminated, n_items, items (sorted item ids), coverage (the largest, 0 without one) of every row of ``docs``."""
    found = contaminated(docs, items, least, key=key, text=text)
    found = stored(found.groupBy("id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage")), "contaminated")
    ids = docs.select(F.col(key).cast("long").alias("doc_id"))
    out = ids.join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    none = F.array().cast("array<bigint>")
    return out.select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def clean(docs: DataFrame, items: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, columns unchanged, that hold no benchmark item."""
    found = stored(contaminated(docs, items, least, key=key, text=text).select(F.col("id").alias("__found")).distinct(), "contaminated")
    return docs.join(found, F.col(key).cast("long").eqNullSafe(F.col("__found")), "left_anti")
