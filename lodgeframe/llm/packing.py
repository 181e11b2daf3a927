"""Harmonic packing of tokenised documents into fixed-size sequences.

Class j holds pieces of length in (C / (j + 1), C / j]; a bin of class j takes
exactly j of them. The last class holds every shorter piece and fills its bins
by length, next fit. Each worker (scan task) fills its own bins, streaming, with
no shuffle. A document longer than C gives whole sequences first; the rest is a
piece of its class if it fills the class's share to within ``slack``, else it is
cut to the largest share C / j that fits and the remainder goes on. Cutting to
shares keeps padding near C mod j tokens a bin.

A bin that a worker leaves open hands its pieces on: per class, the leftovers of
all workers are numbered by a running sum over workers and fill bins of j
again (the last class: by the running length). Less than one bin a class
remains, whatever the size of the input; these pieces share the last
sequences, first fit.

Defined cases: a null or empty text is the end token alone, as one piece of
length 1; repeated rows and ids are packed as separate documents; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import gc
import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.llm.common import materialize

TABLE_WORDS = 600_000     # the word table starts anew beyond
RUN_WORDS = 512           # words encoded at once
TEXTS = 256               # texts whose new words are gathered at once
MARK = "\x01"
END = "\n"               # stands for the end id: no word holds a line break
LATIN_END = "\u0250"
SIGNS = ".,!?;:*&%$#"
ODD_BLANKS = re.compile("[\x1c-\x1f]")
ASCII_BLANKS = re.compile("[ \t\n\x0b\x0c\r]+")
BIN_BITS, SHARE_BITS = 30, 12     # sequence_id: worker, class, bin of that worker



def _byte_chars() -> dict[int, int]:
    """The printable stand-ins of byte-level vocabularies: the n-th other byte is 256 + n."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + n for n, b in enumerate(others)}


BYTE_CHARS = _byte_chars()
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "share long, worker long, k long, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Rows(dict):
    """Table row of a word; -1 where it has none."""

    def __missing__(self, word: str) -> int:
        return -1


class WordTokenizer:
    """Token ids of a text, word by word, each distinct word encoded once.

    For tokenizers that lower-case, drop white space and never merge across it. New words
    are encoded many at a time, parted by a mark whose id shows where a word ends; a word of
    letters that ends in signs is the word and the signs, if normalising leaves it letters:
    a mark at its end would make one unit with the signs. The table of words is bounded: it
    starts anew when full.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = np.array([end_id], dtype=np.int64)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        # A run of letters is one unit of such tokenizers: the model itself can be asked.
        self.direct = all(self.ask(w) == self.tokenizer.encode(w, add_special_tokens=False).ids
                          for w in ("a", "letters", "straßenüberführung", "pretokenisation"))
        self.reset()

    def reset(self) -> None:
        self.index = Rows()
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.start = np.zeros(1 << 14, dtype=np.int32)
        self.size = np.zeros(1 << 14, dtype=np.int32)
        self.used = 0
        self.add([END], self.end, np.ones(1, dtype=np.int64))

    def words(self, text: str | None) -> list[str]:
        text = text or ""
        if "<|" not in text:              # else a special token may be spelled out
            text = text.lower() if text.isascii() else text.encode().lower().decode()
        return ASCII_BLANKS.split(text) if ODD_BLANKS.search(text) else text.split()

    def ask(self, word: str) -> list[int]:
        raw = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)
        return [t.id for t in self.model.tokenize(raw)]

    def encode_words(self, new: list[str]) -> None:
        """Put words into the table: lower-case Latin words by the model, words with other
        characters in joined runs, and what may hold a mark or a special token one by one."""
        if self.direct:
            letters = [w for w in new if w.isalpha() and w < LATIN_END and max(w) < LATIN_END
                       and w == w.lower()]
            ask = self.ask
            ids = [ask(w) for w in letters]
            self.add(letters, np.fromiter(chain.from_iterable(ids), dtype=np.int64),
                     np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
            done = set(letters)
            new = [w for w in new if w not in done]
        joined = [w for w in new if self.mark is not None and MARK not in w and "<|" not in w]
        for at in range(0, len(joined), RUN_WORDS):
            run = joined[at:at + RUN_WORDS]
            ids = np.array(self.tokenizer.encode_batch_fast(
                [f" {MARK} ".join(run)], add_special_tokens=False)[0].ids, dtype=np.int64)
            ends = np.append(np.nonzero(ids == self.mark)[0], len(ids))
            sizes = np.diff(ends, prepend=-1) - 1
            if len(sizes) != len(run):
                raise ValueError("a word of this tokenizer holds the id of the mark")
            self.add(run, ids[ids != self.mark], sizes)
        if len(joined) < len(new):
            rest = sorted(set(new) - set(joined))
            ids = [e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)]
            self.add(rest, np.array([i for x in ids for i in x], dtype=np.int64),
                     np.array([len(x) for x in ids], dtype=np.int64))

    def add(self, new: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        k, n = len(self.index), len(new)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while k + n > len(self.start):
            m = 2 * len(self.start)
            self.start, self.size = np.resize(self.start, m), np.resize(self.size, m)
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[k:k + n] = self.used + np.cumsum(sizes) - sizes
        self.size[k:k + n] = sizes
        self.used += len(ids)
        self.index.update(zip(new, range(k, k + n)))

    def look_up(self, found: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, found), dtype=np.int64, count=len(found))

    def gather(self, k: np.ndarray) -> np.ndarray:
        """Ids of a sequence of table rows."""
        size = self.size[k]
        after = np.cumsum(size, dtype=np.int64)
        total = int(after[-1]) if len(after) else 0
        return self.ids[np.repeat(self.start[k] - (after - size), size) + np.arange(total)]

    def learn(self, new: set[str]) -> None:
        signed = []
        for w in new:
            b = w.rstrip(SIGNS)
            if b != w and b.isalpha() and (
                    b.isascii() or unicodedata.normalize("NFC", b).lower().isalpha()):
                signed.append((w, b, w[len(b):]))
        need = new.difference(w for w, _, _ in signed)
        need.update(b for _, b, _ in signed)
        need.update(e for _, _, e in signed)
        need.difference_update(self.index)
        self.encode_words(list(need))
        if signed:
            k = np.column_stack([self.look_up([b for _, b, _ in signed]),
                                 self.look_up([e for _, _, e in signed])])
            self.add([w for w, _, _ in signed], self.gather(k.ravel()),
                     self.size[k].sum(axis=1))

    def encode_all(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text and the end id."""
        for at in range(0, len(texts), TEXTS):
            if len(self.index) > TABLE_WORDS:
                self.reset()
            found: list[str] = []
            closes = []
            for t in texts[at:at + TEXTS]:
                found += self.words(t)
                found.append(END)
                closes.append(len(found))
            # One call looks all words up; the second END keeps its result a tuple.
            k = np.fromiter(itemgetter(*found, END)(self.index), dtype=np.int64,
                            count=len(found))
            missing = np.nonzero(k < 0)[0].tolist()
            if missing:
                words = [found[i] for i in missing]
                self.learn(set(words))
                k[missing] = self.look_up(words)
            ids = self.gather(k)
            stops = np.cumsum(self.size[k])[np.array(closes) - 1].tolist()
            begin = 0
            for stop in stops:
                yield ids[begin:stop]
                begin = stop


def cuts(n: int, capacity: int, shares: int, slack: float) -> list[int]:
    """Lengths of a document's pieces, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        j = min(capacity // rest, shares)
        room = capacity // j
        if rest >= room * (1 - slack) or j == shares:
            out.append(rest)
            break
        piece = capacity // (j + 1)
        out.append(piece)
        rest -= piece
    return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048,
         shares: int = 32, slack: float = 0.01, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece; see ``PIECE``. ``worker`` and ``k`` say where it was dealt."""
    columns = [c.split()[0] for c in PIECE.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        coder = WordTokenizer(tokenizer_path, end_id)
        bins, filled = [0] * (shares + 1), 0
        waiting: list[list] = [[] for _ in range(shares + 1)]

        def close(j: int) -> list:
            seq = (worker << (BIN_BITS + SHARE_BITS)) | (j << BIN_BITS) | bins[j]
            bins[j] += 1
            offset, done = 0, []
            for p in waiting[j]:
                done.append((*p, j, worker, 0, seq, offset))
                offset += p[2]
            waiting[j] = []
            return done

        gc.disable()      # the many short-lived lists below form no cycles
        for b in batches:
            rows: list = []
            for doc, ids in zip(b.column("doc_id").to_pylist(),
                                coder.encode_all(b.column("text").to_pylist())):
                start = 0
                for length in cuts(len(ids), capacity, shares, slack):
                    j = min(capacity // length, shares)
                    if j == shares and filled + length > capacity:
                        rows += close(j)
                        filled = 0
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    waiting[j].append((doc, start, length, crc, len(ids)))
                    start += length
                    if j == shares:
                        filled += length
                    elif len(waiting[j]) == j:
                        rows += close(j)
            yield _frame(rows, columns)
        gc.enable()
        left = []
        for j in range(1, shares + 1):
            k = 0
            for p in waiting[j]:
                left.append((*p, j, worker, k, None, None))
                k += p[2] if j == shares else 1
        yield _frame(left, columns)

    dealt = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                    F.col(text_col).cast("string").alias("text")).mapInArrow(deal, PIECE))
    full = dealt.where("sequence_id IS NOT NULL")
    open_ = dealt.where("sequence_id IS NULL").drop("sequence_id", "offset")

    # Leftovers: number them per class by a running sum over workers, then fill bins of j.
    # A bin of the last class takes the pieces that start inside its span of lengths.
    short = F.col("share") == shares
    span = F.when(short, capacity - capacity // shares + 1).otherwise(F.col("share"))
    per_worker = open_.groupBy("share", "worker").agg(
        F.sum(F.when(short, F.col("length")).otherwise(1)).alias("n"))
    order = W.partitionBy("share").orderBy("worker")
    per_worker = per_worker.withColumn("first", F.sum("n").over(
        order.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).withColumn(
        "total", F.sum("n").over(W.partitionBy("share")))
    numbered = open_.join(per_worker, ["share", "worker"]).withColumn(
        "at", F.col("first") + F.col("k"))
    numbered = materialize(numbered.withColumn("bin", F.floor(F.col("at") / span)))
    whole = numbered.where((F.col("bin") + 1) * span <= F.col("total"))
    in_bin = W.partitionBy("share", "bin").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    marker = -1 - ((F.col("share").cast("long") * F.lit(1 << (62 - SHARE_BITS)))
                   + F.col("bin")) * 2
    whole = whole.withColumn("sequence_id", marker).withColumn(
        "offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))

    names = full.columns

    def last_bins(group: pa.Table) -> pa.Table:
        room: list[int] = []
        group = group.sort_by([("length", "descending"), ("share", "ascending"),
                               ("at", "ascending")])
        seqs, offsets = [], []
        for n in group.column("length").to_pylist():
            i = next((i for i, r in enumerate(room) if r >= n), len(room))
            if i == len(room):
                room.append(capacity)
            seqs.append(-2 - 2 * i)
            offsets.append(capacity - room[i])
            room[i] -= n
        placed = {"sequence_id": pa.array(seqs, pa.int64()),
                  "offset": pa.array(offsets, pa.int64())}
        return pa.table([placed[c] if c in placed else group.column(c) for c in names],
                        names=names)

    # Less than one bin a class, whatever the size of the input.
    last = numbered.where((F.col("bin") + 1) * span > F.col("total")) \
        .withColumn("all", F.lit(0)).groupBy("all").applyInArrow(last_bins, PIECE)
    return full.unionByName(whole.select(full.columns)).unionByName(last)


def _frame(rows: list, columns: list[str]) -> pa.RecordBatch:
    """Pieces as Arrow longs, which keep nulls and all 64 bits of an id."""
    data = list(zip(*rows)) if rows else [[] for _ in columns]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in data], names=columns)
