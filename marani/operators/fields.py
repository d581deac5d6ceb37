"""Several values packed in one field: one row for each value, with its position (problem 3).

Every field is parsed under each dialect that it may be written in: a set of separators, quotes that protect or not, numbers
that keep the sign inside them or not. A dialect is worth the bits in which the field can be told: its own, and those of each
value, which is told by how often it occurs in the other fields (its code length, from counts that are made by a distributed
aggregation) or else letter by letter. Values are counted as all separators and quotes of a field have it; so a value that holds
a separator counts where it is quoted. A separator or quote that nothing protects is told inside a value by letters at the
price of how seldom that is in all fields, and at none where the value is known as a whole. Each field is parsed by its cheapest dialect.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import settle
from .membership import Filter, filter_of

# Separators, with the full-width forms of each, and pairs of quotes.
SEPARATORS = ["|｜", ";；;", ",，", "/／", "、､", "·・", "\t", "\n\r"]
QUOTES = ['""', "＂＂", "„“", "„”", "“”", "«»", "‹›"]
SIGNS = ",，/／"
#: Bits: of a letter, of a value that is told by letters, of each choice in a dialect.
LETTER, NEW_VALUE, CHOICE = 5.0, 12.0, 2.0
#: Separators that are taken to have separated before any is seen, so that few fields don't make it doubtful.
BEFOREHAND = 1 << 16
_all = "".join(SEPARATORS)
_quote_marks = "".join(sorted({c for q in QUOTES for c in q}))
_quoted = "|".join(f"{re.escape(a)}(?:[^{re.escape(b)}]|{re.escape(b * 2)})*{re.escape(b)}" for a, b in QUOTES)
_number = re.compile(rf"(?<![^\W_])\d+(?:[{SIGNS}]\d+)+(?![^\W_])")
ROWS_PER_BATCH = 1000


@lru_cache(4096)
def _pattern(separators: str, quotes: bool, numbers: int) -> re.Pattern[str]:
    stop = re.escape(separators)
    plain = f"[^{stop}]" if separators else r"[\s\S]"
    sign = "".join(c for c in SIGNS if c in separators)
    more = r"(?:(?P=sign)\d+)*" if numbers == 2 else ""
    number = rf"(?<![^\W_])\d+(?P<sign>[{sign}])\d+{more}(?![^\W_])|" if numbers and sign else ""
    end = f"[{stop}]|$" if separators else "$"
    return re.compile((rf"\s*({_quoted})\s*(?:{end})|" if quotes else "()(?!)|") + rf"(?P<plain>(?:{number}{plain})*)(?:{end})")


def parse(field: str, separators: str = _all, quotes: bool = True, numbers: int = 2) -> list[tuple[str, bool]]:
    """The values of a field under one dialect, each with whether it was quoted; empty values are left out.

    ``numbers``: 2 keeps written numbers with any number of one sign, 1 with one sign only, 0 splits them."""
    out, at, pattern = [], 0, _pattern(separators, quotes, numbers)
    while at < len(field):
        m = pattern.match(field, at)
        if m[1]:
            close = m[1][-1]
            value, quoted = m[1][1:-1].replace(close * 2, close).strip(), True
        else:
            value, quoted = m["plain"].strip(), False
        if value:
            out.append((value, quoted))
        at = m.end() if m.end() > at else at + 1
    return out


def _letters(value: str, quoted: bool, price: dict[str, float]) -> float:
    """Bits of a value told by letters; ``price`` has those of separators and quotes that nothing protects."""
    rest = "" if quoted else _number.sub("0", value)
    return NEW_VALUE + LETTER * len(value) + sum(price[c] - LETTER for c in rest if c in price)


def dialects(field: str) -> list[tuple[str, bool, int]]:
    """The dialects that read a field differently, the likeliest first: all its separators, all but one, one alone, or none."""
    own = [s for s in SEPARATORS if any(c in field for c in s)]
    sets = ["".join(own)]
    if len(own) > 1:
        sets += ["".join(s for s in own if s != left) for left in own] + own
    if own:
        sets.append("")
    quotes = [True, False] if any(c in field for c in _quote_marks) else [True]
    numbers = [2, 1, 0] if _number.search(field) else [2]
    return list(dict.fromkeys(product(sets, quotes, numbers)))


@dataclass
class Costs:
    """What bounds the bits of values before they are looked up: the price of each separator and quote that nothing protects,
    the bits of the most frequent value, and a filter of the known values that hold such a character."""

    price: dict[str, float]
    least: float
    known: Filter

    def least_of(self, value: str, letters: float, quoted: bool) -> float:
        """No more than the value's bits. A value that holds a free separator and isn't known is told by letters."""
        if not quoted and any(c in self.price for c in value) and not self.known.may_hold_one(xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42)):
            return letters
        return min(letters, self.least)


def _candidates(field: str, costs: Costs) -> list[tuple[float, list[str], list[float], list[int]]]:
    """Each differing parse: the dialect's bits, its values, and for each value its bits by letters and how often it counts itself."""
    seen, out, least, own = set(), [], [], Counter()
    for n, (separators, quotes, numbers) in enumerate(dialects(field)):
        found = parse(field, separators, quotes, numbers)
        if not n:
            own.update(v for v, _ in found)
        key = tuple(found)
        if key in seen:
            continue
        seen.add(key)
        base, letters = CHOICE * (1 + math.log2(1 + n)), [_letters(v, q, costs.price) for v, q in found]
        out.append((base, [v for v, _ in found], letters, [own[v] for v, _ in found]))
        least.append(base + sum(costs.least_of(v, x, q) for (v, q), x in zip(found, letters)))
    # A parse is left out only if another costs less even if all its values are new, and this one's are known as well as can be.
    best = min(base + sum(letters) for base, _, letters, _ in out)
    return [c for c, x in zip(out, least) if x <= best + 1e-3]


def _by_batch(make: Callable[[list[str]], list[tuple]], schema: T.StructType, keep: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that makes rows of each field (the last column), after the first ``keep`` columns of its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [to_arrow_type(f.dataType) for f in schema.fields[keep:]]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                place, rows = [], []
                for n, field in enumerate(b.column(keep).to_pylist()):
                    new = make(field)
                    place += [n] * len(new)
                    rows += new
                take = pa.array(place, pa.int64())
                made = zip(*rows) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([*(b.column(n).take(take) for n in range(keep)), *(pa.array(list(x), k) for x, k in zip(made, kinds))], names=schema.names)

    return run


def value_counts(fields: DataFrame) -> tuple[DataFrame, int, Costs]:
    """``value``, ``n`` over all fields (``field``), parsed by all their separators and quotes; their number; and what values cost.

    A separator or quote that nothing protects is told inside a value by the rule of succession over all that stand in fields
    beside values, of which none is seen inside one, and BEFOREHAND more."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    each = fields.select("field").mapInArrow(_by_batch(lambda field: [(v,) for v, _ in parse(field)], schema, 0), schema)
    counts = settle(each.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "values")
    kinds = [*SEPARATORS, _quote_marks]
    number = lambda text, k, n: F.sum(n * F.length(F.regexp_replace(text, f"[^{re.escape(k)}]", "")))
    special = F.col("value").rlike(f"[{re.escape(''.join(kinds))}]")
    total, most, holding, *inside = (x or 0 for x in counts.agg(F.sum("n"), F.max("n"), F.count_if(special), *(number("value", k, F.col("n")) for k in kinds)).first())
    found = (x or 0 for x in fields.agg(*(number("field", k, F.lit(1)) for k in kinds)).first())
    price = {c: math.log2(BEFOREHAND + max(0, n - m)) for k, n, m in zip(kinds, found, inside) for c in k}
    known = filter_of(counts.where(special).select(F.xxhash64("value")), holding)
    return counts, total, Costs(price, math.log2(total / most) + 1 if most else 0.0, known)


def unpack(df: DataFrame, id_col: str = "row_id", field_col: str = "keywords_ka", out_col: str = "keyword") -> DataFrame:
    """``id_col``, ``pos``, ``out_col``: the values of each field in their order; ``pos`` counts from 0 and skips empty values.

    Null, empty and valueless fields give no row. Values are without outer white space and the quotes around them; a closing
    quote that is doubled inside stands for one. A written number with its sign inside is one value where that is cheaper.
    Repeated rows give repeated results, each field is parsed whole, and other columns aren't read."""
    chosen = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{field_col}`").cast("string").alias("field")).where("field is not null")
    counts, total, costs = value_counts(chosen)
    sent = df.sparkSession.sparkContext.broadcast(costs)
    rows = chosen.withColumn("row", F.monotonically_increasing_id()).select("id", "row", "field")
    more = (("dialect", T.IntegerType()), ("of", T.IntegerType()), ("base", T.DoubleType()), ("values", T.ArrayType(T.StringType())), ("letters", T.ArrayType(T.DoubleType())), ("own", T.ArrayType(T.IntegerType())))
    schema = T.StructType([chosen.schema["id"], T.StructField("row", T.LongType()), *(T.StructField(n, k) for n, k in more)])

    def parses_of(field: str) -> list[tuple]:
        found = _candidates(field, sent.value)
        return [(n, len(found), *x) for n, x in enumerate(found)] if any(v for _, v, _, _ in found) else []

    parses = settle(rows.mapInArrow(_by_batch(parses_of, schema, 2), schema), "parses")
    several = parses.where("of > 1").select("id", "row", "dialect", "base", F.posexplode_outer(F.arrays_zip("values", "letters", "own")).alias("pos", "x"))
    each = several.select("id", "row", "dialect", "base", "pos", F.col("x.values").alias("value"), F.col("x.letters").alias("letters"), F.col("x.own").alias("own"))
    others = F.col("n") - F.col("own")  # the field itself doesn't vouch for its own values
    code = F.when(others > 0, F.least("letters", F.log2(F.lit(float(total)) / others) + 1)).otherwise(F.col("letters"))
    bits = F.coalesce(code, F.lit(0.0))
    scored = (
        each.join(counts, "value", "left")
        .groupBy("row", "dialect")
        .agg((F.first("base") + F.sum(F.round(bits, 6))).alias("bits"), F.first("id").alias("id"), F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("pos", "value")))).alias("list"))
        .groupBy("row")
        .agg(F.min_by(F.struct("id", "list"), F.struct("bits", "dialect")).alias("best"))
        .select(F.col("best.id").alias("id"), F.explode("best.list").alias("x"))
        .select("id", F.col("x.pos").alias("pos"), F.col("x.value").alias("value"))
    )
    alone = parses.where("of = 1").select("id", F.posexplode("values").alias("pos", "value"))
    return alone.unionByName(scored).select(F.col("id").alias(id_col), "pos", F.col("value").alias(out_col))
