"""Line dedup by content-defined chunks of lines, in DataFrame expressions only.

A text is a list of lines. The rolling hash at a line mixes its hash with those of
the lines before it; where it is 0 modulo ``spread`` a chunk ends, so boundaries move
with the content when lines are inserted further up. A line of ``long_line`` words or
more is always a chunk of its own. Chunks of at least two lines, and such long lines,
that occur more than once anywhere are removed except for their first occurrence,
after a comparison of their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.llm.storage import stored


def line_hash(line: Column) -> Column:
    """First 48 bits of the MD5 digest: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(line), 1, 12), 16, 10).cast("long")


def long_line_test(line: Column, words: int) -> Column:
    plain = F.translate(line, "\t\x0b\x0c\r", "    ")
    return (F.octet_length(line) >= 2 * words - 1) & (F.size(F.filter(F.split(plain, " "), lambda w: w != "")) >= words)


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once per row. A generator of one row stands between their expressions and
    what reads them; otherwise the optimiser writes an array's expression into a lambda that runs for each element."""
    made = df.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("__held"))
    return made.select(*df.columns, *(F.col("__held")[n].alias(n) for n in columns))


def with_chunks(df: DataFrame, text: str, spread: int, long_line: int) -> DataFrame:
    """``df`` with ``__chunks``: array of (n, body, long), the chunks in order; joined by line breaks they are the text. Null: no chunks."""
    lines = _held(df, __lines=F.transform(F.split(F.col(text), "\n", -1), lambda s: F.struct(s.alias("s"), line_hash(s).alias("h"), long_line_test(s, long_line).alias("long"))))
    before = F.expr("slice(array_prepend(transform(__lines, x -> x.h), 0L), 1, size(__lines))")
    after = F.expr("slice(array_append(transform(__lines, x -> x.long), true), 2, size(__lines))")
    met = lambda x, i: F.when(x["l"]["long"] | x["after"] | (F.pmod(x["l"]["h"] * 31 + x["before"], F.lit(spread)) == 0), i + 1)
    stops = F.array_compact(F.transform(F.arrays_zip(F.col("__lines").alias("l"), before.alias("before"), after.alias("after")), met))
    cut = _held(lines, __stops=stops, __texts=F.transform("__lines", lambda x: x["s"]), __longs=F.transform("__lines", lambda x: x["long"])).drop("__lines")
    starts = F.expr("slice(array_prepend(__stops, 0), 1, size(__stops))")
    chunk = lambda p: F.struct(
        (p["hi"] - p["lo"]).alias("n"), F.array_join(F.slice("__texts", p["lo"] + 1, p["hi"] - p["lo"]), "\n").alias("body"), F.element_at("__longs", p["hi"]).alias("long")
    )
    return _held(cut, __chunks=F.transform(F.arrays_zip(starts.alias("lo"), F.col("__stops").alias("hi")), chunk)).drop("__stops", "__texts", "__longs")


def repeated_chunks(df: DataFrame, key: str, text: str, spread: int, long_line: int) -> DataFrame:
    """(__id, __drop): for every document the numbers of the chunks that an earlier place also holds.

    Only hashes are grouped over the whole corpus; texts are moved for chunks whose hash
    repeats, and compared there with the first one's, byte by byte. Chunks that share a
    64-bit hash with another text stay. Texts meet tables that grow with the corpus by the
    same shuffled join at every size. The first place is the smallest key (null first),
    then the smallest number. The two small tables are stored, so that Spark sees their
    size and can split the rows of a chunk that a third of the documents hold.
    """
    chunks = with_chunks(df.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text")), "__text", spread, long_line)
    placed = chunks.select("__id", F.posexplode("__chunks").alias("at", "c")).filter("c.n > 1 OR c.long")
    place = (F.coalesce(F.col("__id").cast("decimal(20,0)"), F.expr("CAST('-9223372036854775809' AS DECIMAL(20,0))")) * F.lit(1 << 31).cast("decimal(11,0)") + F.col("at")).cast("decimal(38,0)")
    placed = placed.select("__id", "at", place.alias("place"), F.xxhash64("c.body").alias("h"), F.col("c.body").alias("body"))
    firsts = stored(placed.groupBy("h").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last").select("h", "first"), "chunk-hashes")
    same = stored(placed.join(firsts.hint("merge"), "h").select("__id", "at", "place", "h", "first", "body"), "chunks")
    bodies = stored(same.filter("place = first").select("h", F.col("body").alias("first_body")).dropDuplicates(["h"]), "first-chunks")
    twice = same.filter("place > first").join(bodies, "h").filter("body = first_body")
    return twice.select("__id", "at").distinct().groupBy("__id").agg(F.collect_list("at").alias("__drop"))


def line_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", spread: int = 3, long_line: int = 50) -> DataFrame:
    """``df`` with the repeated chunks taken out of ``text``; all rows, other columns and their order stay.

    New columns n_lines, removed_lines and removed_chars (code points, line breaks
    included) come last and replace columns of these names. A null text stays null with
    0 lines; an empty text is one empty line; a text whose chunks all go becomes empty.
    Rows that repeat a key are one document: their chunks of equal number are one
    place, and what is removed is removed in each of them. Null keys are one document.
    An empty table gives no rows.
    """
    base = df.drop("n_lines", "removed_lines", "removed_chars")
    drops = repeated_chunks(df, key, text, spread, long_line)
    joined = base.join(drops.hint("merge"), F.col(key).cast("long").eqNullSafe(F.col("__id")), "left").drop("__id")
    cut = with_chunks(joined.withColumn("__cut", F.when(F.col("__drop").isNotNull(), F.col(text))), "__cut", spread, long_line)
    lines = F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    kept = F.filter("__chunks", lambda c, i: ~F.array_contains("__drop", i))
    cut = _held(cut, __kept=F.when(F.col("__drop").isNotNull(), kept), __all=lines)
    body = F.when(F.col("__kept").isNull(), F.col(text)).otherwise(F.array_join(F.transform("__kept", lambda c: c["body"]), "\n"))
    left = F.when(F.col("__kept").isNull(), F.col("__all")).otherwise(F.aggregate("__kept", F.lit(0), lambda s, c: s + c["n"]))
    out = _held(cut, __new=body, __left=left)
    return out.select(
        *(F.col("__new").alias(c) if c == text else F.col(c) for c in base.columns),
        F.col("__all").cast("long").alias("n_lines"), (F.col("__all") - F.col("__left")).cast("long").alias("removed_lines"),
        (F.coalesce(F.length(text), F.lit(0)) - F.coalesce(F.length("__new"), F.lit(0))).cast("long").alias("removed_chars"),
    )


def _units(df: DataFrame, long_line: int) -> DataFrame:
    """(__id, unit, h) of ``df`` (__id, __text): unit 2 * k is the pair of lines k and k + 1, unit 2 * k + 1 is line k if long."""
    lines = _held(df, __lines=F.split(F.col("__text"), "\n", -1)).drop("__text")
    after = F.expr("slice(array_append(__lines, CAST(NULL AS STRING)), 2, size(__lines))")
    each = lines.select("__id", F.posexplode(F.arrays_zip(F.col("__lines").alias("s"), after.alias("t"))).alias("k", "x"))
    unit = lambda test, kind, h: F.when(test, F.struct((F.col("k").cast("long") * 2 + kind).alias("unit"), h.alias("h")))
    both = F.array_compact(F.array(unit(F.col("x.t").isNotNull(), 0, _pair_hash(F.col("x.s"), F.col("x.t"))), unit(long_line_test(F.col("x.s"), long_line), 1, F.xxhash64("x.s"))))
    return each.select("__id", F.explode(both).alias("u")).select("__id", "u.unit", "u.h")


def _pair_hash(s: Column, t: Column) -> Column:
    return F.xxhash64(s, F.lit("\n"), t)


def repeated_lines(df: DataFrame, key: str, text: str, long_line: int) -> DataFrame:
    """(__id, __drop): for every document the numbers of the lines that stand in a pair of lines, or are a long line, which an earlier place also holds.

    Every pair is hashed, so a shared passage is found whatever stands around it. Texts do
    not travel with the hashes: documents with a repeated hash are read again, and their
    pairs are compared with the first ones byte by byte.
    """
    docs = df.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text"))
    place = (F.coalesce(F.col("__id").cast("decimal(20,0)"), F.expr("CAST('-9223372036854775809' AS DECIMAL(20,0))")) * F.lit(1 << 32).cast("decimal(11,0)") + F.col("unit")).cast("decimal(38,0)")
    placed = _units(docs, long_line).withColumn("place", place)
    firsts = stored(placed.groupBy("h").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last").select("h", "first"), "pair-hashes")
    met = stored(placed.join(firsts.hint("merge"), "h").select("__id", "unit", "h", F.expr("place = first").alias("first")).distinct(), "pairs")
    wanted = stored(met.groupBy(F.col("__id").alias("__wanted")).agg(F.collect_list(F.struct("unit", "h", "first")).alias("__units")), "pairs-of-documents")
    again = docs.join(wanted.hint("merge"), F.col("__id").eqNullSafe(F.col("__wanted"))).drop("__wanted")
    again = _held(again, __lines=F.split(F.col("__text"), "\n", -1)).drop("__text")
    line = lambda k: F.get("__lines", k.cast("int"))
    body = lambda u: F.struct(
        u["unit"].alias("unit"), u["h"].alias("h"), u["first"].alias("first"), line(F.floor(u["unit"] / 2)).alias("s"), F.when(u["unit"] % 2 == 0, line(F.floor(u["unit"] / 2) + 1)).alias("t")
    )
    bodies = _held(again, __bodies=F.transform("__units", body)).select("__id", F.explode("__bodies").alias("u")).select("__id", "u.*")
    same = F.when(F.col("unit") % 2 == 0, _pair_hash(F.col("s"), F.col("t"))).otherwise(F.xxhash64("s")) == F.col("h")  # rows of one key may differ
    bodies = stored(bodies.filter(same), "pair-bodies")
    first = stored(bodies.filter("first").select("h", F.col("s").alias("first_s"), F.col("t").alias("first_t")).dropDuplicates(["h"]), "first-pairs")
    twice = bodies.filter("not first").join(first, "h").filter("s = first_s AND t <=> first_t")
    gone = twice.select("__id", F.explode(F.expr("IF(unit % 2 = 0, array(unit DIV 2, unit DIV 2 + 1), array(unit DIV 2))")).alias("k")).distinct()
    return gone.groupBy("__id").agg(F.collect_list(F.col("k").cast("int")).alias("__drop"))


def passage_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", long_line: int = 50) -> DataFrame:
    """``df`` with repeated passages taken out of ``text``: every run of two or more lines whose neighbouring pairs all stood
    at earlier places, and every line of ``long_line`` words or more that did.

    Unlike chunks, runs end where the repetition ends, not where a hash of the lines around
    them says. The first place of a line's text is never removed: a pair that holds it has
    no earlier place. Columns, nulls, empty texts and repeated keys are as in ``line_dedup``.
    """
    base = df.drop("n_lines", "removed_lines", "removed_chars")
    drops = stored(repeated_lines(df, key, text, long_line), "repeated-lines")
    joined = base.join(drops.hint("merge"), F.col(key).cast("long").eqNullSafe(F.col("__id")), "left").drop("__id")
    cut = _held(joined, __lines=F.when(F.col("__drop").isNotNull(), F.split(F.col(text), "\n", -1)))
    cut = _held(cut, __kept=F.array_except(F.expr("sequence(0, size(__lines) - 1)"), F.col("__drop")))
    lines = F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    body = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join(F.transform("__kept", lambda k: F.get("__lines", k)), "\n"))
    left = F.when(F.col("__lines").isNull(), lines).otherwise(F.size("__kept"))
    out = _held(cut, __new=body, __all=lines, __left=left)
    return out.select(
        *(F.col("__new").alias(c) if c == text else F.col(c) for c in base.columns),
        F.col("__all").cast("long").alias("n_lines"), (F.col("__all") - F.col("__left")).cast("long").alias("removed_lines"),
        (F.coalesce(F.length(text), F.lit(0)) - F.coalesce(F.length("__new"), F.lit(0))).cast("long").alias("removed_chars"),
    )
