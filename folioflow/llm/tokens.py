"""Encoding of a corpus with a public tokenizer through a table of distinct words.

The tokenizer's own pattern splits texts into words in Spark; each distinct
word is encoded once. Ids come back by position: every word that isn't among
the HOT_WORDS most frequent ones is joined with the word table. The hot ones,
whose join would gather a word of every text in one task, get their ids from a
broadcast part of that table. The vocabulary is read once, by the driver, and
broadcast (a fixed table).

Edge cases: null and empty texts have an empty list; special tokens' strings in a
text are ordinary text; repeated rows count once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut_lineage, each_once

FOLDER = "/opt/tokenizers"
NAME = "byte_bpe_50k"
#: Fixed value: the public pattern that splits text for this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words in the broadcast part of the word table: those frequent enough to be skewed keys of the join.
HOT_WORDS = 4_000


@lru_cache(maxsize=4)
def vocabulary(name: str = NAME, folder: str = FOLDER) -> bytes:
    return (Path(folder) / f"{name}.tiktoken").read_bytes()


def ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in file.splitlines() if x.strip())}


@lru_cache(maxsize=4)
def encoder(file: bytes):
    import tiktoken

    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks(file), special_tokens={})


def split_words(text: str = "text"):
    """The words of a text, in order (JVM side). White space is Unicode's, as in the tokenizer."""
    return F.regexp_extract_all(F.col(text), F.lit("(?U)" + PATTERN), F.lit(0))


def word_table(documents: DataFrame, name: str = NAME, folder: str = FOLDER) -> DataFrame:
    """(word, n, ids) of each distinct word of the corpus, encoded once."""
    counts = documents.select(F.explode(split_words()).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(name, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shared.value)
        for b in batches:
            ids = pa.array([e.encode_ordinary(w) for w in b.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids], ["word", "n", "ids"])

    return counts.mapInArrow(run, "word string, n bigint, ids array<int>")


def encoded(documents: DataFrame, name: str = NAME, folder: str = FOLDER, hot_words: int = HOT_WORDS, key: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of each document."""
    docs = each_once(documents.select(key, "text"), key)
    words = cut_lineage(word_table(documents.filter("text is not null"), name, folder))
    hot = {r.word: tuple(r.ids) for r in words.orderBy(F.desc("n"), "word").limit(hot_words).collect()}
    shared = documents.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for b in batches:
            # one flat list of ids and one of rare words for the batch, with the offsets of the texts in both
            ids, ends, at, no, word, rare_ends = [], [0], [], [], [], [0]
            for ws in b.column(1).to_pylist():
                begin = len(ids)
                for i, w in enumerate(ws or ()):
                    x = get(w)
                    if x is None:
                        at.append(len(ids) - begin)
                        no.append(i)
                        word.append(w)
                    else:
                        ids += x
                ends.append(len(ids))
                rare_ends.append(len(word))
            rare = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(no, pa.int32()), pa.array(word, pa.string())], ["at", "no", "word"])
            lists = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), v) for o, v in ((ends, pa.array(ids, pa.int32())), (rare_ends, rare))]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], [key, "ids", "cold"])

    kind = documents.schema[key].dataType.simpleString()
    looked = docs.select(key, split_words().alias("words")).mapInArrow(run, f"{key} {kind}, ids array<int>, cold array<struct<at int, no int, word string>>")
    looked = cut_lineage(looked.withColumn("row", F.monotonically_increasing_id()))
    rare = looked.select("row", F.explode("cold").alias("c")).select("row", "c.at", "c.no", "c.word").join(words.select("word", F.col("ids").alias("more")), "word")
    pieces = rare.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "no", "more"))).alias("pieces"))
    return looked.join(pieces, "row", "left").select(key, spliced("ids", "pieces").alias("ids"))


def spliced(ids: str, pieces: str):
    """The looked-up ids with the rare words' ids put in at their places, in order."""
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("from"))

    def step(acc, p):
        before = F.slice(F.col(ids), acc["from"] + 1, p["at"] - acc["from"])
        return F.struct(F.concat(acc["done"], before, p["more"]).alias("done"), p["at"].alias("from"))

    def end(acc):
        return F.concat(acc["done"], F.slice(F.col(ids), acc["from"] + 1, F.size(ids)))

    return F.when(F.col(pieces).isNull(), F.col(ids)).otherwise(F.aggregate(F.col(pieces), start, step, end))


def pieces(spark, name: str = NAME, folder: str = FOLDER) -> DataFrame:
    """(id, piece) of the vocabulary: a fixed table of about 50,000 rows."""
    return spark.createDataFrame([(i, bytearray(b)) for b, i in ranks(vocabulary(name, folder)).items()], "id int, piece binary")


def decoded(ids: DataFrame, name: str = NAME, folder: str = FOLDER, key: str = "doc_id") -> DataFrame:
    """(doc_id, text) from (doc_id, ids): each id is joined with its piece, and the pieces are put together by position."""
    rows = ids.select(key, F.posexplode_outer("ids").alias("at", "id"))
    joined = rows.join(F.broadcast(pieces(ids.sparkSession, name, folder)), "id", "left")
    by_doc = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", F.hex("piece").alias("h")))).alias("p"))
    text = F.decode(F.unhex(F.array_join(F.transform("p", lambda x: F.coalesce(x["h"], F.lit(""))), "")), "UTF-8")
    return by_doc.select(key, text.alias("text"))
