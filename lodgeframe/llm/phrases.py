"""Collocations by set-oriented mining: sorted occurrence relations, extended length by length.

The occurrence relation of length k holds, for each place of a text, the frequent phrase
of k words that starts there. It is written once a length, sorted by piece and position and
clustered in blocks: a row holds one block of a language, as the block's phrases and one
number a position (0: none, or the end of a piece), compressed. Words are named by
themselves, longer phrases by the number of the frequent phrase, so that only integers
are exchanged.

1. Length 1: texts become words; every word is a phrase.
2. Count: each block sends its phrases with their counts, one row a phrase of a block; sums
   are pre-aggregated before the exchange. Phrases of ``least`` occurrences or more are
   frequent.
3. Tell: a block learns which of its phrases are frequent, and its relation is written anew
   without the others. A word's blocks learn it by a join with the frequent words; a longer
   phrase's rows meet in one exchange, where a window gives them their sum and number.
4. Extend: the merge-join of the relation with itself by piece and adjacent position; both
   sides are sorted, so it is one pass over neighbours. A phrase of k + 1 words arises where
   its first and its last k words are frequent. Back to 2, up to ``longest`` words.

Scores are exact integers: products are decimals of up to 38 digits.

Blocks hold ``BLOCK_BYTES`` of text; a longer text is cut between pieces, so nothing grows
with a document or a language.

Defined cases: a null text is empty; a null language is ``und``; empty and blank texts have
no words; repeated rows count each; a piece of any length is one piece (it alone can make
a block larger); ties in rank go by count, then phrase, so they are never open; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.llm.common import materialize

BLOCK_BYTES = 16_000_000
OPEN_BYTES = 48_000_000     # text of unfinished blocks that a task holds
SENT_ROWS = 200_000         # rows of one Arrow batch
BREAK = b"\xff"             # no byte of UTF-8
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
RELATION = "lang string, block long, names binary, names_size long, ids binary, size long"


class Numbers(dict):
    """Numbers words in the order they come."""
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def pack(values: bytes) -> bytes:
    return pa.compress(values, codec="zstd", asbytes=True)


def unpack(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _row(lang: str, block: int, names: bytes, ids: np.ndarray) -> pa.RecordBatch:
    """A block: the names of its phrases from number 1 on, and a number a position."""
    values = [(lang, pa.string()), (block, pa.int64()), (pack(names), pa.binary()),
              (len(names), pa.int64()), (pack(ids.astype("<i4").tobytes()), pa.binary()),
              (len(ids), pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values],
                                      names=[c.split()[0] for c in RELATION.split(", ")])


def parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about a block, cut between pieces."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        cut = text.find(BREAK, at + BLOCK_BYTES)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def occurrences(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """The relation of single words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32

        def close(lang: str) -> pa.RecordBatch:
            nonlocal number
            tokens = BREAK.join(open_.pop(lang)).replace(BREAK, b" \xff ").split()
            del held[lang]
            known = Numbers({BREAK: 0})
            ids = np.fromiter(map(known.__getitem__, tokens), dtype=np.int32, count=len(tokens))
            number += 1
            return _row(lang, number, b"\n".join(list(known)[1:]), ids)

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(),
                                  b.column("text").cast(pa.binary()).to_pylist()):
                for part in parts(text.lower().translate(BREAKS)):
                    open_.setdefault(lang, []).append(part)
                    held[lang] = held.get(lang, 0) + len(part)
                    if held[lang] >= BLOCK_BYTES:
                        yield close(lang)
            while sum(held.values()) > OPEN_BYTES:
                yield close(max(held, key=held.get))
        for lang in list(open_):
            yield close(lang)

    return docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, RELATION)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, language, block, names, number a position) of each block."""
    for b in batches:
        for row in b.to_pylist():
            ids = np.frombuffer(unpack(row["ids"], 4 * row["size"]), dtype="<i4")
            yield row, unpack(row["names"], row["names_size"]), ids


def neighbours(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, code) of each longer phrase: the phrases at a place and at the next one."""
    first, second = ids[:-1], ids[1:]
    at = np.nonzero((first > 0) & (second > 0))[0]
    return at, first[at].astype(np.int64) * (n + 1) + second[at]


def words_of(relation: DataFrame) -> DataFrame:
    """(lang, phrase, block, g, n): the words of each block with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, names, ids in _blocks(batches):
            words = pa.array(names.split(b"\n") if names else [], pa.binary()).cast(pa.string())
            n = np.bincount(ids, minlength=len(words) + 1)[1:]
            for s in range(0, len(words), SENT_ROWS):
                part = words[s:s + SENT_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(part), pa.string()), part,
                     pa.array(np.full(len(part), row["block"], dtype=np.int64)),
                     pa.array(np.arange(s, s + len(part), dtype=np.int32)),
                     pa.array(n[s:s + len(part)].astype(np.int64))],
                    names=["lang", "phrase", "block", "g", "n"])

    return relation.mapInArrow(run, "lang string, phrase string, block long, g int, n long")


def longer_of(relation: DataFrame) -> DataFrame:
    """(p, q, block, g, n): the longer phrases of each block with their counts.

    A phrase is named by the frequent phrases at its place and the next one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, names, ids in _blocks(batches):
            name = np.frombuffer(names, dtype="<i8")
            codes, n = np.unique(neighbours(ids, len(name))[1], return_counts=True)
            for s in range(0, len(codes), SENT_ROWS):
                part = codes[s:s + SENT_ROWS]
                p, q = np.divmod(part, len(name) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[p - 1]), pa.array(name[q - 1]),
                     pa.array(np.full(len(part), row["block"], dtype=np.int64)),
                     pa.array(np.arange(s, s + len(part), dtype=np.int32)),
                     pa.array(n[s:s + len(part)].astype(np.int64))],
                    names=["p", "q", "block", "g", "n"])

    return relation.mapInArrow(run, "p long, q long, block long, g int, n long")


def frequent_rows(groups: DataFrame, least: int) -> DataFrame:
    """(p, q, f, id, block, g): the rows of the frequent longer phrases, numbered by phrase.

    A phrase's number is that of its first row, which alone holds p, q and f. Rows are
    exchanged once: no join meets them with the sums.
    """
    phrase = W.partitionBy("p", "q")
    rows = groups.withColumn("row", F.monotonically_increasing_id()).withColumns({
        "f": F.sum("n").over(phrase), "id": F.min("row").over(phrase)})
    return rows.where(F.col("f") >= least).select(*[
        F.when(F.col("row") == F.col("id"), F.col(c)).alias(c) for c in ("p", "q", "f")],
        "id", "block", "g")


def kept(relation: DataFrame, told: DataFrame, extend: bool) -> DataFrame:
    """The relation of the frequent groups ``told`` (id, block, g): names are their ids from now on."""
    told = told.groupBy("block").agg(F.collect_list(F.struct("g", "id")).alias("told"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = b.column("told")
            for i, (row, names, ids) in enumerate(_blocks([b.drop_columns(["told"])])):
                g, name = (f.to_numpy(zero_copy_only=False) for f in told[i].values.flatten())
                order = np.argsort(g)
                if extend:
                    at, codes = neighbours(ids, len(names) // 8)
                    codes, where = np.unique(codes, return_inverse=True)
                else:
                    at = np.nonzero(ids)[0]
                    codes, where = np.arange(ids.max(initial=0)), ids[at] - 1
                number = np.zeros(len(codes), dtype=np.int32)
                number[g[order]] = np.arange(1, len(g) + 1)
                out = np.zeros(len(ids), dtype=np.int32)
                out[at] = number[where]
                yield _row(row["lang"], row["block"], name[order].astype("<i8").tobytes(), out)

    return relation.join(told, "block").mapInArrow(run, RELATION)


def counted(docs: DataFrame, longest: int, least: int, text_col: str,
            lang_col: str) -> tuple[list[DataFrame], DataFrame]:
    """(frequent phrases (lang, phrase, f) by length; (lang, n): words of each language)."""
    relation = materialize(occurrences(docs, text_col, lang_col))
    found, names, words = [], None, None
    for k in range(1, longest + 1):
        groups = words_of(relation) if k == 1 else longer_of(relation)
        keys = ["lang", "phrase"] if k == 1 else ["p", "q"]
        # Written with their numbers, which therefore stay what they are.
        if 1 < k < longest:
            told = materialize(frequent_rows(groups, least))
            frequent = told.where("f IS NOT NULL").select(*keys, "f", "id")
        else:
            sums = groups.groupBy(*keys).agg(F.sum("n").alias("f"))
            if k == 1:
                sums = materialize(sums)
                words = sums.groupBy("lang").agg(F.sum("f").alias("n"))
            frequent = materialize(sums.where(F.col("f") >= least).withColumn(
                "id", F.monotonically_increasing_id()))
            told = groups.select(*keys, "block", "g").join(frequent.select(*keys, "id"), keys)
        if k < longest:
            relation = materialize(kept(relation, told, k > 1))
        if k > 1:
            start = names.select(F.col("id").alias("p"), "lang", F.col("phrase").alias("start"))
            rest = names.select(F.col("id").alias("q"), F.substring_index("phrase", " ", -1)
                                .alias("last"))
            frequent = materialize(frequent.join(start, "p").join(rest, "q").select(
                "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "f", "id"))
        names = frequent
        found.append(frequent.select("lang", "phrase", "f"))
    return found, words


def scored(found: list[DataFrame]) -> DataFrame:
    """(lang, phrase, k, a, l, r, score): each candidate by its lowest-scoring cut."""
    cuts = []
    for k in range(2, len(found) + 1):
        for j in range(1, k):
            def side(n: int, name: str) -> DataFrame:
                return found[n - 1].select(F.col("lang").alias(f"{name}_lang"),
                                           F.col("phrase").alias(f"{name}_phrase"),
                                           F.col("f").alias(name))
            c = found[k - 1].select(
                "lang", "phrase", F.col("f").alias("a"), F.lit(k).alias("k"),
                F.substring_index("phrase", " ", j).alias("start"),
                F.substring_index("phrase", " ", j - k).alias("rest"))
            c = c.join(side(j, "l"), (F.col("lang") == F.col("l_lang"))
                       & (F.col("start") == F.col("l_phrase")))
            c = c.join(side(k - j, "r"), (F.col("lang") == F.col("r_lang"))
                       & (F.col("rest") == F.col("r_phrase")))
            wide = {x: F.col(x).cast("decimal(19,0)") for x in "alr"}
            c = c.withColumns({"over": wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)"),
                               "under": wide["l"] * wide["r"]})
            cuts.append(c.select("lang", "phrase", "k", "a", F.struct(
                F.expr("over div under").alias("score"), F.lit(j).alias("cut"), "l", "r").alias("c")))
    every = cuts[0]
    for c in cuts[1:]:
        every = every.unionByName(c)
    return every.groupBy("lang", "phrase", "k", "a").agg(F.min("c").alias("c")).select(
        "lang", "phrase", "k", "a", "c.l", "c.r", "c.score")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside_percent: int = 50,
                 top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A phrase goes if a longer candidate holds it and has ``inside_percent`` of its
    occurrences or more.
    """
    if longest < 2:
        raise ValueError("longest >= 2")
    found, words = counted(docs, longest, least, text_col, lang_col)
    best = scored(found)
    for k in range(2, longest):
        for longer in found[k:]:
            w = F.split("phrase", " ")
            inner = longer.select("lang", "f", F.explode(F.transform(
                F.sequence(F.lit(1), F.size(w) - k + 1),
                lambda i: F.array_join(F.slice(w, i, F.lit(k)), " "))).alias("inner"))
            cover = inner.groupBy(F.col("lang").alias("c_lang"), F.col("inner")).agg(
                F.max("f").alias("cover"))
            best = best.join(cover, (F.col("lang") == F.col("c_lang")) & (
                F.col("phrase") == F.col("inner")), "left").where(
                F.col("cover").isNull()
                | (100 * F.col("cover") < inside_percent * F.col("a"))).drop(
                "c_lang", "inner", "cover")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
