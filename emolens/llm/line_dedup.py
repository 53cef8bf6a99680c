"""Deduplication of repeated passages of lines, in DataFrame operations only.

`remove_shared_runs` (op4, pipeline) finds every passage of two or more worded
lines that lies elsewhere too, also one inside otherwise different documents.
The rolling hash over each two neighbouring worded lines (with the blank lines
between them) is a window of its own, so a match needs no line outside it, and
overlapping windows extend it line by line to its full length.  Windows of one
hash are compared byte for byte; a window that has an earlier place (smaller
document id, then line) takes its lines out, with the blank lines after them.
A window that overlaps its own first place does not count as later.  Every
line taken out is still there at an earlier place.  Lines repeated alone stay.

`remove_repeated_chunks` is the coarser form by content-defined chunks:
a document's lines are hashed; a rolling hash over neighbouring line hashes
chooses chunk boundaries, so that an insertion moves only the boundaries
around it.  A chunk of several lines that occurs elsewhere, byte for byte, is
removed everywhere but at its first place (smallest document id, then first
chunk).  Chunks of one line, and chunks with fewer than two lines that hold
a word, are never removed.

Plan (of both; windows are joined by their hash, and by their bytes only where
one hash has several texts): (1) chunk hashes are counted, without texts; (2) the places of repeated
hashes are gathered per document and meet the documents once; only repeated
chunks' texts move on; (3) they are grouped by their bytes (the comparison),
which gives each text's first place; (4) later places are removed.  Counts
and minima are combined map-side, so a chunk that a third of all documents
share costs one row per task; the joins on it are plain equi-joins, which
adaptive execution splits.

Cases: null texts stay null; empty texts and texts of blank lines stay;
repeated rows (same id and text) are one document: none of their chunks is
later than the other's, so both rows stay; null ids sort first; other columns
pass through; an empty table stays empty.  Very long texts: lines and chunks
are array operations within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emolens.llm.common import free_name, text_or_empty, written

#: A boundary lies before a line when the rolling hash over it and the line
#: before is 0 modulo this: chunks have about so many lines.
MODULUS = 3
#: Two lines with a word at least; anchored and possessive, so one pass.
SEVERAL = r"^[\x20\x09-\x0D]*+[^\x20\x09-\x0D][^\n]*+\n[\x20\x09-\x0D]*+[^\x20\x09-\x0D]"
#: A line end before a line with a word; possessive within the line, so linear.
BEFORE_WORDED = r"\n(?=[\x20\x09\x0B-\x0D]*+[^\x20\x09-\x0D])"
WORDED = r"[^\x20\x09-\x0D]"


def units(text: Column) -> Column:
    """Array of worded lines, each with the blank lines after it; blank lines
    that begin the text are the first unit.  Joined by line ends they are the text."""
    return F.split(text, BEFORE_WORDED, -1)


def _line(unit: Column) -> Column:
    """A unit without its blank lines."""
    return F.substring_index(unit, "\n", 1)


def _window_hashes(text: Column) -> Column:
    """Hash of each two neighbouring units; null where the first holds no word."""
    n = F.size(units(text)) - 1
    return F.zip_with(F.slice(units(text), F.lit(1), n), F.slice(units(text), F.lit(2), n),
                      lambda a, b: F.when(a.rlike(WORDED), F.xxhash64(a, _line(b))))


def _with_units(text: Column, f) -> Column:
    """``f`` of the units, which are made once, not for every use in a lambda."""
    return F.get(F.transform(F.array(units(text)), f), F.lit(0))


def remove_shared_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str | None = None) -> DataFrame:
    """``docs`` without later places of passages of two or more worded lines.

    ``removed`` names an extra column: the number of passages cut."""
    t, h, d, pos, drop = (free_name([*docs.columns, removed or ""], n) for n in ("t_", "h_", "d_", "pos_", "drop_"))
    whole = docs.withColumn(t, text_or_empty(text)).withColumn(d, F.xxhash64(t))
    with_lines = whole.where(F.col(text).isNotNull() & F.col(t).contains("\n")).select(key, d, t)
    places = written(with_lines.select(key, d, F.posexplode(_window_hashes(F.col(t))).alias(pos, h)).where(F.col(h).isNotNull()), "windows")
    repeated = places.groupBy(h).agg(F.count("*").alias("n")).where("n > 1").select(h)
    of_document = places.join(repeated, h).groupBy(key, d).agg(F.collect_set(pos).alias(pos))

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.{key}")) & (F.col(f"{a}.{d}") == F.col(f"{b}.{d}"))

    chosen = _with_units(F.col(f"a.{t}"), lambda u: F.transform(F.col(f"b.{pos}"), lambda i: F.struct(
        i.alias("i"), F.xxhash64(F.get(u, i), _line(F.get(u, i + 1))).alias("h"), F.concat(F.get(u, i), F.lit("\n"), _line(F.get(u, i + 1))).alias("chunk"))))
    suspects = (with_lines.alias("a").join(of_document.alias("b"), same("a", "b"))
                .select(F.col(f"a.{key}").alias(key), F.col(f"a.{d}").alias(d), F.explode(chosen).alias("c"))
                .select(key, d, F.col("c.i").alias(pos), F.col("c.h").alias(h), F.col("c.chunk").alias("chunk")))
    suspects = written(suspects, "suspects")
    place = F.struct(F.col(key), F.col(d), F.col(pos))
    texts = written(suspects.groupBy(h, "chunk").agg(F.min(place).alias("first")), "texts")
    several = texts.groupBy(h).agg(F.count("*").alias("n")).where("n > 1").select(h)
    one = suspects.drop("chunk").join(texts.drop("chunk").join(several, h, "left_anti"), h)
    clashing = suspects.join(several, h, "left_semi").join(texts.join(several, h, "left_semi"), [h, "chunk"]).drop("chunk")
    own = F.col(f"first.{key}").eqNullSafe(F.col(key)) & (F.col(f"first.{d}") == F.col(d))
    later = (one.unionByName(clashing).where((F.col("first") < place) & ~(own & (F.col(f"first.{pos}") == F.col(pos) - 1)))
             .groupBy(key, d).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array(F.col(pos), F.col(pos) + 1))))).alias(drop)))
    cut = F.col(f"b.{drop}")
    kept = _with_units(F.col(f"a.{t}"), lambda u: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(u) - 1), cut), lambda i: F.get(u, i)))
    new = F.when(cut.isNull(), F.col(f"a.{text}")).otherwise(F.array_join(kept, "\n"))
    out = [(new if c == text else F.col(f"a.`{c}`")).alias(c) for c in docs.columns]
    if removed:
        # a passage begins where the line before is not cut
        begins = F.size(F.array_except(cut, F.transform(cut, lambda i: i + 1)))
        out.append(F.when(cut.isNull(), 0).otherwise(begins).alias(removed))
    return whole.alias("a").join(later.alias("b"), same("a", "b"), "left").select(*out)


def chunks(text: Column, modulus: int = MODULUS) -> Column:
    """Array of chunks; joined again by line ends they are the text.

    Every line but the first is led by a flag (1: a chunk begins).  Lines hold
    no line end, so a line end and a 1 mark a boundary and nothing else does;
    the text is split there and the other flags taken out.  Every step is one
    pass over the text."""
    lines = F.split(text, "\n", -1)
    n = F.size(lines) - 1
    flagged = F.zip_with(F.slice(lines, F.lit(1), n), F.slice(lines, F.lit(2), n), lambda a, b: F.concat(
        F.when(F.pmod(F.xxhash64(F.xxhash64(a), F.xxhash64(b)), F.lit(modulus)) == 0, "1").otherwise("0"), b))
    joined = F.array_join(F.concat(F.slice(lines, 1, 1), flagged), "\n")
    return F.transform(F.split(joined, "\n1", -1), lambda c: F.replace(c, F.lit("\n0"), F.lit("\n")))


def _chosen(text: Column, places: Column, modulus: int) -> Column:
    """(i, chunk) of the chunks at some places."""
    marked = F.transform(chunks(text, modulus), lambda c, i: F.when(
        F.array_contains(places, i.cast("int")), F.struct(i.cast("int").alias("i"), c.alias("chunk"))))
    return F.filter(marked, lambda x: x.isNotNull())


def remove_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = MODULUS,
                           removed: str | None = None) -> DataFrame:
    """``docs`` with later places of repeated chunks cut from the text.

    ``removed`` names an extra column: the number of chunks cut."""
    # a document is its id and its text's hash; rows that agree in both are the same
    t, h, d, pos, drop = (free_name([*docs.columns, removed or ""], n) for n in ("t_", "h_", "d_", "pos_", "drop_"))
    whole = docs.withColumn(t, text_or_empty(text)).withColumn(d, F.xxhash64(t))
    # a text of one line has no chunk of several
    with_lines = whole.where(F.col(text).isNotNull() & F.col(t).contains("\n")).select(key, d, t)
    places = (with_lines.select(key, d, F.posexplode(F.transform(
        chunks(F.col(t), modulus), lambda c: F.when(c.rlike(SEVERAL), F.xxhash64(c)))).alias(pos, h))
        .where(F.col(h).isNotNull()))
    places = written(places, "chunks")
    repeated = places.groupBy(h).agg(F.count("*").alias("n")).where("n > 1").select(h)
    of_document = places.join(repeated, h).groupBy(key, d).agg(F.collect_set(pos).alias(pos))

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.{key}")) & (F.col(f"{a}.{d}") == F.col(f"{b}.{d}"))

    suspects = (with_lines.alias("a").join(of_document.alias("b"), same("a", "b"))
                .select(F.col(f"a.{key}").alias(key), F.col(f"a.{d}").alias(d), F.explode(_chosen(F.col(f"a.{t}"), F.col(f"b.{pos}"), modulus)).alias("c"))
                .select(key, d, F.col("c.i").alias(pos), F.col("c.chunk").alias("chunk")))
    suspects = written(suspects, "suspects")
    place = F.struct(F.col(key), F.col(d), F.col(pos))
    first = suspects.groupBy("chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = (suspects.join(first, "chunk").where(F.col("first") < place)
             .groupBy(key, d).agg(F.collect_set(pos).alias(drop)))
    kept = F.filter(F.transform(chunks(F.col(f"a.{t}"), modulus), lambda c, i: F.when(
        ~F.array_contains(F.col(f"b.{drop}"), i.cast("int")), c)), lambda x: x.isNotNull())
    new = F.when(F.col(f"b.{drop}").isNull(), F.col(f"a.{text}")).otherwise(F.array_join(kept, "\n"))
    out = [(new if c == text else F.col(f"a.`{c}`")).alias(c) for c in docs.columns]
    if removed:
        out.append(F.coalesce(F.size(F.col(f"b.{drop}")), F.lit(0)).alias(removed))
    return whole.alias("a").join(later.alias("b"), same("a", "b"), "left").select(*out)
