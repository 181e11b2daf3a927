"""Language-model scores by a weighted backoff automaton.

Model. With c the training counts, N tokens, V distinct tokens and m the mass of
the backoff prior, a word w after history h (h' is h without its first word) has

    p1(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m),

which sums to one over the V words and one unknown word. As an automaton: states
are the histories seen, an arc h -w-> carries log p(w | h) for each n-gram seen,
and a failure arc h -> h' carries log(m / (c(h) + m)). A text is read once from left
to right; the state is the longest seen suffix of what was read, a missing arc
follows failure arcs, and the log weights add up. An end token closes each text
and is the state in which the next one starts.

Scale. No task and no driver holds the whole automaton. Documents are dealt to
blocks by a hash of their content. A block counts its own n-grams and sends them, as
sorted keys with counts, to as many key ranges; a range adds up the counts and
answers each block with the totals that differ from the block's own count, so
n-grams of one block travel once. From these totals the block builds the part of the
automaton that its texts visit (integer states, sorted arcs, failure arcs, corpus-wide
weights) and reads its texts through it. All messages are proportional to the text.

Keys are 56-bit hashes of n-grams: among n of them n^2 / 2^57 pairs meet by chance, so
seven pairs among 10^9. Sorted keys travel as differences, whose upper bytes are zero.

Defined cases: a null text is empty, and an empty text is the end token alone; a null
doc_id counts as the empty text in the fold and is kept; repeated rows count and are
scored each; no training rows give p1 = 1 for the unknown word (scores 0); an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import fold, materialize

END = b"\n"          # no word holds a newline
BLOCK_CHARS = 8_000_000
STRETCH = 512
KEY_BITS = 56
MAX_BLOCKS = 100_000   # beyond, blocks grow: each block sends one message to each range
SCORED = ("doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


@dataclass(frozen=True)
class Backoff:
    order: int = 2
    mass: float = 2.0
    held_out: int = 1
    folds: int = 5


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of an n-gram from the key of its start and the hash of its last word."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)) >> np.uint64(64 - KEY_BITS)


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> (64 - KEY_BITS)


def read(texts) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts, each closed by the end token; tokens per text)."""
    number: dict[bytes, int] = {END: 0}
    ids: list[int] = []
    sizes = []
    for t in texts:
        w = (t or "").encode().lower().split()
        ids += [number.setdefault(x, len(number)) for x in w]
        ids.append(0)
        sizes.append(len(w) + 1)
    hashes = np.fromiter((word_key(w) for w in number), dtype=np.uint64, count=len(number))
    return hashes[np.array(ids, dtype=np.int64)], np.array(sizes, dtype=np.int64)


def gram_keys(h: np.ndarray, sizes: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram length: (key ending at each position, whether it lies inside its text).

    The history of a text's first word is the end token; longer histories do not
    reach over a text's start.
    """
    end = np.uint64(word_key(END))
    first = np.zeros(len(h), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    since = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [(h, np.ones(len(h), dtype=bool))]
    before = np.where(first, end, np.roll(h, 1))
    for n in range(2, order + 1):
        inside = since >= n - 2
        # Key of the history: the (n-1)-gram that ends one position earlier.
        history = before if n == 2 else np.where(first, end, np.roll(out[-1][0], 1))
        out.append((mix(history, h), inside))
    return out


def count_keys(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, their training counts, place of each position's key)."""
    k, where = np.unique(key, return_inverse=True)
    return k, np.bincount(where, weights=weight, minlength=len(k)).astype(np.int64), where


def planes(values: np.ndarray) -> bytes:
    """Differences of sorted keys as byte planes: the upper planes compress away."""
    step = np.diff(values, prepend=np.zeros(1, dtype=np.uint64))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    m = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1)
    step = np.ascontiguousarray(m.T).view(np.uint64).ravel()
    return np.cumsum(step, dtype=np.uint64)


@dataclass(frozen=True)
class Level:
    """The n-grams of one length that occur in a block, numbered by sorted key."""
    counts: np.ndarray      # corpus count of each n-gram
    number: np.ndarray      # per position: the n-gram that ends there, -1 without one
    place: np.ndarray       # per n-gram: a position where it ends


def level(key: np.ndarray, inside: np.ndarray, where: np.ndarray, counts: np.ndarray) -> Level:
    number = np.full(len(key), -1, dtype=np.int32)      # a block has far fewer positions
    number[inside] = where
    place = np.zeros(len(counts), dtype=np.int32)
    place[where] = np.flatnonzero(inside)
    return Level(counts, number, place)


@dataclass(frozen=True)
class Automaton:
    """The part of the backoff automaton that a block's texts visit.

    States are integers; state 0 is the empty history. An arc is found by
    ``state * words + word`` among the sorted ``arc``; each state but 0 has one failure arc.
    """
    words: int
    start: int              # where a text starts: the end token's state
    arc: np.ndarray
    arc_log: np.ndarray
    arc_to: np.ndarray
    fail_log: np.ndarray
    fail_to: np.ndarray
    unknown: float          # weight of a word without an arc at state 0, which it leads to


def build(levels: list[Level], first: np.ndarray, n: int, v: int, mass: float) -> Automaton:
    """Automaton of the n-grams of ``levels`` (shortest first); ``first`` marks text starts."""
    norm = n + 0.5 * (v + 1)
    word = levels[0].number
    end = word[-1]                                  # each text closes with the end token
    state, log_p = [], []                           # per level and n-gram
    fail_to, fail_log = [np.zeros(1, np.int64)], [np.zeros(1)]
    arcs, logs, targets, states = [], [], [], 1
    for i, x in enumerate(levels):
        seen = x.counts > 0
        at = x.place
        if i == 0:
            suffix = history = None
            weight = np.log10((x.counts + 0.5) / norm)
        else:
            suffix = levels[i - 1].number[at]
            history = levels[i - 1].number[at - 1]
            if i == 1:
                history = np.where(first[at], end, history)
            weight = np.log10((x.counts + mass * 10.0 ** log_p[i - 1][suffix])
                              / (levels[i - 1].counts[history] + mass))
        log_p.append(weight)
        longest = i == len(levels) - 1
        if longest:
            own = state[i - 1][suffix] if i else np.zeros(len(seen), np.int64)
        else:
            own = np.where(seen, states - 1 + np.cumsum(seen), 0)
            states += int(seen.sum())
            fail_to.append((state[i - 1][suffix] if i else np.zeros(len(seen), np.int64))[seen])
            fail_log.append(np.log10(mass / (x.counts[seen] + mass)))
        state.append(own)
        source = state[i - 1][history[seen]] if i else 0
        arcs.append(source * len(levels[0].counts) + word[at[seen]].astype(np.int64))
        logs.append(weight[seen])
        targets.append(own[seen].astype(np.int32))
    arc = np.concatenate(arcs)
    order = np.argsort(arc)
    start = int(state[0][end]) if len(levels) > 1 else 0
    return Automaton(len(levels[0].counts), start, arc[order], np.concatenate(logs)[order],
                     np.concatenate(targets)[order], np.concatenate(fail_log),
                     np.concatenate(fail_to).astype(np.int32), float(np.log10(0.5 / norm)))


def advance(a: Automaton, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(states after reading one word in each given state, weights of the arcs taken)."""
    state, weight = state.copy(), np.zeros(len(state))
    todo = np.arange(len(state))
    while len(todo):
        here = state[todo].astype(np.int64)
        sought = here * a.words + word[todo]
        at = np.searchsorted(a.arc, sought)
        hit = at < len(a.arc)
        hit[hit] = a.arc[at[hit]] == sought[hit]
        taken = todo[hit]
        weight[taken] += a.arc_log[at[hit]]
        state[taken] = a.arc_to[at[hit]]
        lost = ~hit & (here == 0)
        weight[todo[lost]] += a.unknown
        back = ~hit & (here != 0)
        weight[todo[back]] += a.fail_log[here[back]]
        state[todo[back]] = a.fail_to[here[back]]
        todo = todo[back]
    return state, weight


def traverse(a: Automaton, word: np.ndarray, sizes: np.ndarray, order: int,
             stretch: int = STRETCH) -> np.ndarray:
    """Weight of each position, from one left-to-right pass over every text.

    Texts advance side by side, a word a step, each with its own state. A long text is cut
    into stretches: reading the ``order - 1`` words before a stretch from the empty history
    leads to the state that the whole text before it leads to.
    """
    stretch = max(stretch, order)
    begin = np.cumsum(sizes) - sizes
    cuts = -(-sizes // stretch)
    which = np.repeat(np.arange(len(sizes)), cuts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    at = begin[which] + nth * stretch
    stop = np.minimum(at + stretch, begin[which] + sizes[which])
    warm = np.where(nth > 0, order - 1, 0)
    at = at - warm
    by_length = np.argsort(at - stop, kind="stable")
    at, warm = at[by_length], warm[by_length]
    length = stop[by_length] - at
    state = np.where(nth[by_length] == 0, a.start, 0)
    out = np.zeros(len(word))
    for t in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -t, side="left"))
        here = at[:live] + t
        state[:live], weight = advance(a, state[:live], word[here])
        counted = warm[:live] <= t
        out[here[counted]] = weight[counted]
    return out


def score_texts(docs: DataFrame, model: Backoff | None = None, id_col: str = "doc_id",
                text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    m = model or Backoff()
    order, mass = m.order, m.mass
    # Ids go through pandas as text: beside a null, longs would become doubles there.
    base = docs.select(
        F.col(id_col).cast("long").cast("string").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (fold(F.col(id_col), m.folds) == m.held_out).alias("held_out"))
    total = base.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = min(int(total // block_chars) + 1, MAX_BLOCKS)
    dealt = base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"),
                                            F.lit(blocks)).cast("int"))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        h, sizes = read(group["text"])
        train = np.repeat((~group["held_out"]).to_numpy(np.float64), sizes)
        block, rows = int(group["block"].iloc[0]), []
        for i, (key, inside) in enumerate(gram_keys(h, sizes, order)):
            k, c, _ = count_keys(key[inside], train[inside])
            cut = np.searchsorted(k, np.array([(r << KEY_BITS) // blocks for r in range(blocks)],
                                              dtype=np.uint64))
            cut = np.append(cut, len(k))
            rows += [(block, i, r, planes(k[a:b]), c[a:b].astype("<u4").tobytes())
                     for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
        return pd.DataFrame(rows, columns=["block", "gram", "part", "keys", "counts"])

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        runs = [unplanes(k) for k in group["keys"]]
        counts = [np.frombuffer(c, dtype="<u4").astype(np.int64) for c in group["counts"]]
        _, sums, where = count_keys(np.concatenate(runs), np.concatenate(counts))
        gram, out, at = int(group["gram"].iloc[0]), [], 0
        for block, k, c in zip(group["block"], runs, counts):
            whole = sums[where[at:at + len(k)]]
            at += len(k)
            more = whole != c
            if more.any():
                out.append((block, gram, planes(k[more]),
                            whole[more].astype("<u8").tobytes(), 0, 0))
        # One row of sums: seen types and training tokens of this range.
        out.append((-1, gram, b"", b"", int((sums > 0).sum()), int(sums.sum())))
        return pd.DataFrame(out, columns=["block", "gram", "keys", "totals", "types", "tokens"])

    sent = dealt.groupBy("block").applyInPandas(
        count, "block int, gram int, part int, keys binary, counts binary")
    answers = materialize(sent.groupBy("gram", "part").applyInPandas(
        add_up, "block int, gram int, keys binary, totals binary, types long, tokens long"))
    state = answers.where("block = -1 AND gram = 0").agg(F.sum("types"), F.sum("tokens")).first()
    v, n = int(state[0] or 0), int(state[1] or 0)

    def score(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame(columns=names)
        h, sizes = read(texts["text"])
        train = np.repeat((~texts["held_out"]).to_numpy(np.float64), sizes)
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(len(h), dtype=bool)
        first[starts] = True
        levels, grams = [], gram_keys(h, sizes, order)
        del h
        for i in range(order):
            key, inside = grams[i]
            k, c, where = count_keys(key[inside], train[inside])
            grams[i] = None                 # each length's keys go once they are numbered
            for keys, totals in told.loc[told["gram"] == i, ["keys", "totals"]].itertuples(
                    index=False):
                c[np.searchsorted(k, unplanes(keys))] = np.frombuffer(totals, dtype="<u8")
            levels.append(level(key, inside, where, c))
        del key, inside, where, k, train
        word, counts = levels[0].number, levels[0].counts
        automaton = build(levels, first, n, v, mass)
        del levels
        log_p = traverse(automaton, word, sizes, order)
        base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))[word]
        return pd.DataFrame({
            "doc_id": texts["doc_id"].array, "held_out": texts["held_out"].array,
            "n_tokens": sizes,
            "n_known": np.add.reduceat((counts > 0)[word].astype(np.int64), starts),
            "train_tokens": n, "base_score": np.add.reduceat(base, starts),
            "score": np.add.reduceat(log_p, starts)})[names]

    names = [c.split()[0] for c in SCORED.split(", ")]
    told = answers.where("block >= 0").select("block", "gram", "keys", "totals")
    scored = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(score, SCORED)
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))
