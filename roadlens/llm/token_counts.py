"""Token counts: pieces are counted once per distinct pre-token, joined to the
per-document pre-token frequencies and summed; no ids are materialised.

The piece model must keep spaces and line ends: no piece may hold a space mark
after another character, nor a line end (checked when the model is loaded).
Then a text, with the model's leading space, falls into pre-tokens that start
at each run of spaces and at each line end, and their counts add up.

Edge cases: null and empty texts have 0 bytes and 0 tokens; every input row
gives one row, repeated rows and equal doc_ids included (rows are told apart by
a row number of this job); an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written

MARK = "▁"
_PRETOKEN = re.compile(r"\n[^ \n]*| +[^ \n]*")
_models: dict = {}


def model(path: str):
    """The worker's SentencePiece model of a file."""
    if path not in _models:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if MARK in piece.lstrip(MARK) or "\n" in piece:
                raise ValueError(f"piece {i} spans a pre-token border")
        _models[path] = sp
    return _models[path]


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, the model's leading space included."""
    return _PRETOKEN.findall(" " + text.replace(MARK, " ")) if text else []


def count_pieces(sp, words: list[str]) -> list[int]:
    """Pieces of each pre-token. The model adds a space of its own, so one is
    taken off a pre-token that has it, and counted off one that has none."""
    n = list(map(len, sp.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)))
    return [1 if w == " " else k if w[0] == " " else k - 1 for w, k in zip(words, n, strict=True)]


def count_tokens(docs: DataFrame, path: str, frequent: int = 200_000, least_in_task: int = 8) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs`` (doc_id, text).

    Three steps: (1) the pre-tokens that tasks see at least ``least_in_task``
    times are summed, and the ``frequent`` most common ones (a bound, whatever
    the input) are counted and broadcast; (2) one pass turns each document into
    its frequencies, summing the broadcast ones at once; (3) the rest, none of
    them a hot key, is dealt by pre-token, counted once each and joined there. The
    split between (2) and (3) does not change the result."""
    spark = docs.sparkSession
    ship_package(spark)

    def common(batches):
        import pyarrow as pa
        seen: Counter = Counter()

        def out():
            kept = [(w, n) for w, n in seen.items() if n >= least_in_task]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], ["word", "n"])
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(pretokens(t or ""))
            if len(seen) > 1_500_000:
                yield out()
                seen.clear()
        yield out()

    def pieces(batches):
        import pyarrow as pa
        sp = model(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count_pieces(sp, words), pa.int64())], ["word", "pieces"])

    top = (docs.select("text").mapInArrow(common, "word string, n long")
           .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(frequent).select("word"))
    known = spark.sparkContext.broadcast({r.word: r.pieces for r in top.mapInArrow(pieces, "word string, pieces long").collect()})

    def frequencies(batches):
        import pyarrow as pa
        table = known.value
        tail = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))
        for batch in batches:
            ids, size, sums, rest = batch.column(0), [], [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                total, left = 0, []
                for w, n in Counter(pretokens(t)).items():
                    k = table.get(w)
                    if k is None:
                        left.append({"word": w, "n": n})
                    else:
                        total += n * k
                size.append(len(t.encode()))
                sums.append(total)
                rest.append(left)
            yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, tail)],
                                             ["doc_id", "n_bytes", "n_known", "rest"])

    per_doc = written(docs.select("doc_id", "text").mapInArrow(
        frequencies, "doc_id long, n_bytes long, n_known long, rest array<struct<word:string,n:int>>")
        .withColumn("row", F.monotonically_increasing_id()), "token-frequencies")

    def weigh(batches):
        import pyarrow as pa
        sp, table = model(path), {}
        for batch in batches:
            words = batch.column(1).to_pylist()
            new = list(set(words).difference(table))
            table.update(zip(new, count_pieces(sp, new), strict=True))
            n = np.array(list(map(table.__getitem__, words)), np.int64) * batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n)], ["row", "n"])

    # one shuffle brings the occurrences of a pre-token to one task, which counts it once
    rest = per_doc.select("row", F.explode("rest").alias("x")).select("row", "x.word", F.col("x.n").cast("long").alias("n"))
    sums = rest.repartition("word").mapInArrow(weigh, "row long, n long").groupBy("row").agg(F.sum("n").alias("n_rest"))
    return (per_doc.join(sums, "row", "left")
            .select("doc_id", "n_bytes", (F.col("n_known") + F.coalesce("n_rest", F.lit(0))).alias("n_tokens")))
