"""Question numbers and marks from positioned words of a page's text layer.

words: (doc_id, page, width, height, x0, y0, x1, y1, word).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import strip

#: Beginnings of running header and footer words.
HEADER_WORD = r"(?i)^(?:CANDIDATE|CENTRE|Cambridge|University|Press|Assessment|Turn over|Licensed|Trace|Downloaded|PapaCambridge|[0-9]{1,3}$|9709/?)"
_PAGE = ["doc_id", "page"]


def question_numbers(words: DataFrame) -> DataFrame:
    """(doc_id, page, number, y): one- and two-digit words in the left margin, above the foot, of readable height."""
    w = strip(F.coalesce("word", F.lit("")))
    ok = w.rlike(r"^\d{1,2}$") & (F.col("x0") < 0.12 * F.col("width")) & (F.col("y1") < 0.92 * F.col("height")) & (F.col("y1") - F.col("y0") >= 6)
    return words.filter(ok).select(*_PAGE, w.try_cast("int").alias("number"), F.col("y0").alias("y"))


def mark_words(words: DataFrame) -> DataFrame:
    """(doc_id, page, mark, y, x): words that are exactly [N]."""
    m = F.regexp_extract(strip(F.coalesce("word", F.lit(""))), r"^\[(\d{1,2})\]$", 1)
    return words.withColumn("m", m).filter("m <> ''").select(*_PAGE, F.col("m").try_cast("int").alias("mark"), F.col("y0").alias("y"), F.col("x0").alias("x"))


def band_marks(words: DataFrame) -> DataFrame:
    """(doc_id, page, number, mark, y, x): each mark belongs to the last number at or above its top; marks above the first are dropped.

    Of equal numbers on a page the lower band wins. One window instead of a
    range join: numbers and marks in one stream, the number carried forward.
    """
    numbers = question_numbers(words).select(*_PAGE, "y", F.lit(None).cast("double").alias("x"), "number", F.lit(None).cast("int").alias("mark"), F.lit(0).alias("what"))
    marks = mark_words(words).select(*_PAGE, "y", "x", F.lit(None).cast("int").alias("number"), "mark", F.lit(1).alias("what"))
    down = Window.partitionBy(*_PAGE).orderBy("y", "what").rowsBetween(Window.unboundedPreceding, 0)
    both = numbers.unionByName(marks).withColumn("band", F.last(F.when(F.col("what") == 0, F.struct("number", "y")), True).over(down))
    lowest = Window.partitionBy(*_PAGE, "band.number")
    held = both.filter("band is not null").withColumn("lowest", F.max("band.y").over(lowest))
    return held.filter("what = 1 and band.y = lowest").select(*_PAGE, F.col("band.number").alias("number"), "mark", "y", "x")


def orphan_marks(words: DataFrame) -> DataFrame:
    """Marks of pages without any question number."""
    return mark_words(words).join(question_numbers(words).select(*_PAGE).distinct(), _PAGE, "left_anti")


def rebuilt_text(words: DataFrame) -> DataFrame:
    """(doc_id, page, text): words by line (tops rounded to a tenth, half to even), header words and dotted lines dropped."""
    w = words.filter(F.col("word").rlike(r"(?U)\S") & ~strip(F.col("word")).rlike(HEADER_WORD))
    line = w.withColumn("line", F.bround("y0", 1)).groupBy(*_PAGE, "line").agg(F.array_sort(F.collect_list(F.struct("x0", "word"))).alias("ws"))
    text = strip(F.array_join(F.transform("ws", lambda x: x["word"]), " "))
    line = line.select(*_PAGE, "line", text.alias("t")).filter(~F.col("t").rlike(r"^[. ]*$"))
    return line.groupBy(*_PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "t"))), lambda x: x["t"]), "\n").alias("text"))


def _lettered(part_id: Column) -> Column:
    return part_id.rlike(r"\([a-z]\)$")


def fill_marks(parts: DataFrame, bands: DataFrame) -> DataFrame:
    """parts (doc_id, page, ord, id, marks) with missing marks filled from the bands (doc_id, page, number, mark, y, x).

    Unmarked lettered parts get the last marks of their question in order (the
    first ones where there are fewer); a lone mark goes to an unmarked first
    stem when no lettered part lacks its mark.
    """
    number = F.regexp_extract("id", r"^(\d{1,2})", 1).try_cast("int")
    p = parts.withColumn("number", number)
    key = [*_PAGE, "number"]
    lettered = _lettered(F.col("id"))
    p = p.withColumn("open", lettered & F.col("marks").isNull())
    rank = Window.partitionBy(*key, "open").orderBy("ord")
    stem_rank = Window.partitionBy(*key, lettered).orderBy("ord")
    whole = Window.partitionBy(*key)
    p = p.withColumn("r", F.row_number().over(rank)).withColumn("stem_r", F.row_number().over(stem_rank)).withColumn("n_open", F.sum(F.col("open").cast("int")).over(whole))
    m = bands.withColumn("i", F.row_number().over(Window.partitionBy(*key).orderBy("y", "x"))).withColumn("n_marks", F.count("*").over(Window.partitionBy(*key)))
    n_marks = m.select(*key, "n_marks").distinct()
    p = p.join(n_marks, key, "left")
    first = F.greatest(F.col("n_marks") - F.col("n_open"), F.lit(0))
    want = F.when(F.col("open"), F.col("r") + first).when(
        (F.col("n_open") == 0) & (F.col("n_marks") == 1) & ~lettered & (F.col("stem_r") == 1) & F.col("marks").isNull(), F.lit(1)
    )
    p = p.withColumn("i", want.cast("int"))
    filled = p.join(m.select(*key, "i", "mark"), [*key, "i"], "left")
    return filled.select(*parts.columns[: parts.columns.index("marks")], F.coalesce("marks", "mark").alias("marks"), *parts.columns[parts.columns.index("marks") + 1 :])


def fill_orphans(parts: DataFrame, orphans: DataFrame) -> DataFrame:
    """The i-th part without marks of a page gets its i-th orphan mark."""
    p = parts.withColumn("open", F.col("marks").isNull())
    p = p.withColumn("i", F.when(F.col("open"), F.row_number().over(Window.partitionBy(*_PAGE, "open").orderBy("ord"))))
    m = orphans.withColumn("i", F.row_number().over(Window.partitionBy(*_PAGE).orderBy("y", "x"))).select(*_PAGE, "i", "mark")
    return p.join(m, [*_PAGE, "i"], "left").select(*[F.coalesce("marks", "mark").alias("marks") if c == "marks" else F.col(c) for c in parts.columns])
