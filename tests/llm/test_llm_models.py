"""Quality classifier, language model, near-duplicates, packing, vectors and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lodgeframe.llm import ann, lm, packing, quality, queries, simhash
from llm.helpers import (DOCS, awkward, doc_frame, fingerprint, fold, hamming_components,
                         words)

SF = "/root/testdata/sf0.01"


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_quality_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op1_pu_quality(spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}
    assert len(got) == table(spark, "documents").count()
    assert all(r["held_out"] == (fold(i) == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    held = [(got[i]["score"], q) for i, q in labels.items() if got[i]["held_out"]]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    auc = np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good])
    assert auc > 0.97 and np.mean([s >= 0.3 for s in good]) > 0.97


def test_quality_ignores_held_out_labels(spark):
    labels = table(spark, "labels")
    docs = table(spark, "documents")
    a = quality.train(docs, labels)
    from pyspark.sql import functions as F
    from lodgeframe.llm.common import fold as spark_fold
    flipped = labels.withColumn("quality", F.when(
        spark_fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    b = quality.train(docs, flipped)
    assert a.prior == b.prior and np.allclose(a.weights, b.weights)
    assert 0.6 < a.prior < 0.98


def test_repeated_rows_do_not_fill_the_fit_sample(spark, monkeypatch):
    """Half the rows have one of three ids or none; each id is one row of the sample."""
    docs = spark.createDataFrame(
        [(i, f"text number {i}") for i in range(600)] +
        [(i, f"copy {n % 2}") for i in (-1, -2, -3, None) for n in range(150)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(-3, 300)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u: seen.append((len(p), len(u))))
    quality.train(docs, labels, fit_rows=10_000, folds=1, held_out=1)
    assert seen == [(303, 605)]      # null ids: one row a text
    quality.train(docs, labels, fit_rows=60, folds=1, held_out=1)
    assert 30 < seen[1][0] < 90 and 0 < seen[1][1] < 90


def test_prior_estimate_on_gaussians():
    rng = np.random.default_rng(3)
    p = rng.normal(2, 1, 4000)
    u = np.where(rng.random(4000) < 0.7, rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000))
    assert abs(quality.estimate_prior(p, u) - 0.7) < 0.06


def test_quality_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (99, 1, None), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.train(docs, labels))
    assert got.columns == docs.columns and got.count() == 8
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    empty = spark.createDataFrame([], DOCS)
    assert quality.score(empty, quality.train(empty, labels.limit(0))).count() == 0


def brute_lm(rows, order, mass):
    """rows: (doc_id, text). Dictionary counts and a token-by-token backoff walk."""
    tokens = [[x.encode().lower() for x in words(t)] + ["END"] for _, t in rows]
    train = [t for (i, _), t in zip(rows, tokens) if fold(i) != 1]
    counts = Counter()
    for t in train:
        for i in range(len(t)):
            seen = ["END", *t]
            for n in range(1, order + 1):
                if n <= i + 2:
                    counts[tuple(seen[i + 2 - n:i + 2])] += n > 1 or 1
    n_all = sum(map(len, train))
    v = sum(1 for k in counts if len(k) == 1)

    def log_p(history, w):
        if not history:
            return math.log10((counts[(w,)] + 0.5) / (n_all + 0.5 * (v + 1)))
        seen = counts[tuple(history)]
        lower = 10 ** log_p(history[1:], w)
        return math.log10((counts[(*history, w)] + mass * lower) / (seen + mass))

    out = []
    for (i, _), t in zip(rows, tokens):
        seen = ["END", *t]
        out.append((i, len(t), sum(counts[(w,)] > 0 for w in t), n_all,
                    sum(log_p((), w) for w in t),
                    sum(log_p(seen[max(0, k + 2 - order):k + 1], w) for k, w in enumerate(t))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_matches_brute_force(spark, order):
    rows = [(r["doc_id"], r["text"]) for r in
            table(spark, "documents", "/root/testdata/sf0.001").collect()]
    rows += [(9001, ""), (9002, None), (9003, "The the THE"), (9003, "The the THE"), (None, "x y")]
    docs = doc_frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = lm.score_texts(docs, lm.Backoff(order=order), block_chars=20_000).collect()
    want = brute_lm(rows, order, 2.0)
    key = lambda x: (str(x[0]), x[1:])
    mine = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"],
                    r["base_score"], r["score"]) for r in got), key=key)
    for a, b in zip(mine, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["held_out"] == (fold(r["doc_id"]) == 1) for r in got)


def small_automaton(texts, order, mass=2.0, unread=()):
    """Automaton that learns from ``texts`` and visits ``unread``, too."""
    h, sizes = lm.read([*texts, *unread])
    train = np.repeat(np.arange(len(sizes)) < len(texts), sizes).astype(float)
    first = np.zeros(len(h), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    levels, totals = [], []
    for key, inside in lm.gram_keys(h, sizes, order):
        k, c, where = lm.count_keys(key[inside], train[inside])
        levels.append(lm.level(key, inside, where, c))
        totals.append(c)
    built = lm.build(levels, first, int(totals[0].sum()), int((totals[0] > 0).sum()), mass)
    return built, levels[0].number, sizes


def test_automaton_follows_arcs_then_failures():
    a, word, sizes = small_automaton(["a b a c", "a b"], 3, unread=["z"])
    # The empty history, 4 words with the end token, 6 pairs.
    assert len(a.fail_to) == 1 + 4 + 6 and a.fail_to[a.start] == 0 and a.start > 0
    wa, wc, wz = word[0], word[3], word[8]
    state, weight = lm.advance(a, np.array([a.start]), np.array([wa]))
    i = np.searchsorted(a.arc, a.start * a.words + wa)
    assert state[0] == a.arc_to[i] and weight[0] == a.arc_log[i]
    # No arc c after "end a": two failures (to "a", which has a c arc) make one.
    after, weight = lm.advance(a, state, np.array([wc]))
    to = a.fail_to[state[0]]
    j = np.searchsorted(a.arc, to * a.words + wc)
    assert a.arc[j] == to * a.words + wc and after[0] == a.arc_to[j]
    assert weight[0] == pytest.approx(a.fail_log[state[0]] + a.arc_log[j])
    # A word that nothing holds falls to the empty history.
    lost, weight = lm.advance(a, state, np.array([wz]))
    assert lost[0] == 0 and weight[0] < a.unknown
    # From every state the words and the unknown one sum to one; no text goes on behind
    # a pair that the end token closes.
    closed = set(a.arc_to[a.arc % a.words == word[4]]) - {a.start}
    assert len(closed) == 2
    for s in set(range(len(a.fail_to))) - closed:
        w = lm.advance(a, np.full(a.words, s), np.arange(a.words))[1]
        assert (10 ** w).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_stretches_read_like_whole_texts(order):
    g = np.random.default_rng(order)
    texts = [" ".join(f"w{x}" for x in g.integers(0, 9, n)) for n in (0, 1, 2, 3, 40, 700, 5, 64)]
    a, word, sizes = small_automaton(texts, order)
    whole = lm.traverse(a, word, sizes, order, stretch=10_000)
    for stretch in (1, 2, 5, 64):
        assert (lm.traverse(a, word, sizes, order, stretch) == whole).all()


def test_language_model_awkward_rows(spark):
    got = lm.score_texts(awkward(spark)).collect()
    assert len(got) == 8 and all(r["score"] <= 0 for r in got)
    assert lm.score_texts(spark.createDataFrame([], DOCS)).count() == 0


def test_key_runs_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    assert (lm.unplanes(lm.planes(keys)) == keys).all()
    assert len(lm.unplanes(lm.planes(keys[:0]))) == 0


def check_components(rows, got, max_bits=3):
    want_fp = [fingerprint(t) for _, t in rows]
    label = hamming_components(want_fp, max_bits)
    least = {}
    for (i, _), c in zip(rows, label):
        ids = [x for x in (least.get(c), i) if x is not None]
        least[c] = min(ids) if ids else None
    want = sorted((str(i), f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, want_fp, label))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want


def test_simhash_matches_brute_force(spark):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check_components(rows, simhash.near_duplicates(docs).collect())


def test_simhash_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_components(rows, simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def dense_prints(spark, n=1500, seed=5):
    """One large cloud of near fingerprints, chains at the distance limit, far noise."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(0, 2 ** 63))
    out = {base}
    for _ in range(n):
        x = base
        for b in rng.choice(64, int(rng.integers(1, 8)), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    chain = int(rng.integers(0, 2 ** 63))
    for k in range(0, 60, 3):
        out.add(chain)
        chain ^= 0b111 << k
    out |= {int(x) for x in rng.integers(0, 2 ** 63, 300)}
    fps = sorted(out)
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)), i)
                                   for i, x in enumerate(fps)], "fp long, least long")
    return fps, frame


@pytest.mark.parametrize("max_bits,groups,rows", [(3, 3, 32), (3, 4, 256), (2, 2, 64), (0, 1, 16)])
def test_links_lose_no_pair_when_blocks_split(spark, max_bits, groups, rows):
    fps, frame = dense_prints(spark)
    edges = simhash.links(frame, max_bits, groups, rows).collect()
    at = {int(np.uint64(x).view(np.int64)): i for i, x in enumerate(fps)}
    label = np.arange(len(fps))
    pairs = [(at[e["a"]], at[e["b"]]) for e in edges]
    for a, b in pairs:
        assert (fps[a] ^ fps[b]).bit_count() <= max_bits * len(fps)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    assert (label == hamming_components(fps, max_bits)).all()
    assert len(edges) < 40 * len(fps)


def test_threshold_allocation_is_optimal():
    cost = [[0, 5, 9, 90], [0, 1, 50, 400], [0, 7, 8, 9]]
    best = simhash.allocate(cost, 4)
    assert sum(t + 1 for t in best) == 4
    every = [(cost[0][a] + cost[1][b] + cost[2][c]) for a in range(4) for b in range(4)
             for c in range(4) if a + b + c == 4]
    assert sum(cost[i][t + 1] for i, t in enumerate(best)) == min(every)


def check_packing(spark, docs, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack(docs, packing.default_tokenizer()).collect()
    ids = Counter()
    for i, t in rows:
        a = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        ids[(i, len(a), zlib.crc32(a.tobytes()))] += 1
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    total = {}
    for (i, n, _), copies in ids.items():
        total[(i, n)] = total.get((i, n), 0) + copies * n
    assert {k: sum(r["length"] for r in v) for k, v in by_doc.items()} == total
    for (i, t) in rows[:200]:
        a = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        pieces = {(r["start"], r["length"], r["ids_crc32"]) for r in by_doc[(i, len(a))]}
        at = 0
        for s, n, c in sorted(pieces):
            assert s == at and c == zlib.crc32(a[s:s + n].tobytes())
            at += n
        assert at == len(a)
    used = padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 2048
        used += at
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    return padded / (used + padded)


def test_packing_round_trip(spark):
    docs = table(spark, "documents").repartition(4)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check_packing(spark, docs, rows) < 0.01


def test_packing_awkward_rows(spark):
    docs = awkward(spark)
    check_packing(spark, docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert packing.pack(spark.createDataFrame([], DOCS), packing.default_tokenizer()).count() == 0


def test_word_by_word_ids_equal_whole_text_ids():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    coder = packing.WordTokenizer(packing.default_tokenizer(), 1)
    texts = ["It's we'll I'D don't", "a\x1cb \x1f c", "x y z", "é ́x ﬁ",
             "<|endoftext|> <|startoftext|>a", "1234 ΣΑΣ İ", "a" * 300 + " " + "!" * 200, "", " \n",
             "日本語 テキスト 😀👍🏽", "''ss 't't", "Word.,!? 3.14. a.b. .. ,x É. ﬁ! x\x01y \x01",
             "<|ENDOFTEXT|> <|EndOfText|>", "a\xa0b\u2028c\x85d", "E\u0301! \u0301."]
    for t, ids in zip(texts, coder.encode_all(texts), strict=True):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids + [1], t


def test_words_that_normalise_to_a_mark_before_signs_keep_their_ids():
    """The last letter of each word ends in a combining mark once normalised."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    coder = packing.WordTokenizer(packing.default_tokenizer(), 1)
    texts = ["TAR\u0130H\u0130.", "\u09b9\u09df,", "\u0939\u095b.", "\u05e9\u05d5\ufb4b,",
             "TAR\u0130H, TAR\u0130H\u0130.!? \u0130& \u095b; \ufb4b:"]
    for t, ids in zip(texts, coder.encode_all(texts), strict=True):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids + [1], t


def test_cuts_cover_and_fit():
    for n in range(1, 5000, 7):
        pieces = packing.cuts(n, 2048, 32, 0.01)
        assert sum(pieces) == n and max(pieces) <= 2048 and len(pieces) <= n // 2048 + 6


def brute_nearest(rows, k):
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q in ok:
        if i % 20:
            continue
        near = sorted((-float(c @ q), j) for j, c in ok if j != i and len(c) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return out


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * 10.0 ** rng.integers(-3, 3)])
            for i in range(400)]
    rows += [(400, None), (420, []), (440, [0.0] * 8), (460, [1.0] * 7 + [None]),
             (480, [float("nan")] + [1.0] * 7), (500, [float("inf")] * 8), (None, [1.0] * 8),
             (520, [1.0, 2.0]), (521, [2.0, 1.0]), (20, rows[20][1]), (540, rows[21][1]),
             (541, rows[21][1])]
    df = spark.createDataFrame([(i, v, 1, "q") for i, v in rows],
                               "vec_id long, embedding array<float>, id int, q string")
    got = ann.search(df, lambda i: i % 20 == 0, k=5, query_rows=8, block_rows=64).collect()
    want = {}
    for q, r, j, s in brute_nearest([r for r in rows if r != (20, rows[20][1])] + [(20, rows[20][1])], 5):
        want.setdefault(q, []).append((r, j, s))
    mine = {}
    for r in got:
        mine.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in want:
        if q == 20:
            continue
        for a, b in zip(sorted(mine[q]), want[q], strict=True):
            assert a[0] == b[0] and a[2] == pytest.approx(b[2], rel=1e-12)
    assert mine[520] == [(1, 521, 4.0)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(none, lambda i: i % 20 == 0).count() == 0


def test_long_flat_vectors_keep_exact_ties():
    """+-1 vectors of 1,537 and 4,099 dimensions: codes of 127, sums beyond 2^24, many ties."""
    rng = np.random.default_rng(6)
    for dim in (1537, 4099):
        q = np.ones((4, dim))
        c = np.ones((600, dim))
        for row in c:
            row[rng.choice(dim, 3, replace=False)] = -1.0
        got = ann.tile(np.arange(-4, 0), q, np.arange(600), c, 5)
        assert [(a, b, s) for a, b, s in got] == [
            (a, b, float(dim - 6)) for a in range(-4, 0) for b in range(5)]


def test_tile_bounds_hold():
    rng = np.random.default_rng(9)
    q, c = rng.normal(size=(40, 16)), rng.normal(size=(500, 16)) * 3
    got = ann.tile(np.arange(40), q, np.arange(100, 600), c, 7)
    exact = q @ c.T
    for i in range(40):
        want = np.sort(exact[i])[::-1][:7]
        assert np.allclose([s for a, _, s in got if a == i], want)


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = table(spark, "documents")
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}

    one = stages[0](spark, docs, SF).cache()
    assert one.columns == columns
    kept = {r["doc_id"] for r in one.select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.2 * len(labels)

    two = stages[1](spark, one, SF).cache()
    assert two.columns == columns and two.count() == one.count()

    three = stages[2](spark, two, SF).cache()
    rows = [(r["doc_id"], r["text"]) for r in two.collect()]
    label = hamming_components([fingerprint(t) for _, t in rows], 3)
    want = {}
    for (i, _), c in zip(rows, label):
        want[c] = min(want.get(c, i), i)
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(want.values())

    four = stages[3](spark, three, SF).cache()
    assert four.columns == columns
    size = {r["doc_id"]: len(words(r["text"])) for r in three.collect()}
    taken = Counter()
    for r in four.collect():
        taken[r["doc_id"]] += len(words(r["text"]))
    assert all(taken[i] <= 2 * size[i] for i in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 100

    five = stages[4](spark, four, SF)
    assert five.select("doc_id").distinct().count() == len(taken)


def test_pipeline_on_empty_and_awkward_tables(spark, tmp_path):
    for n, docs in enumerate((awkward(spark).select(*[c.split()[0] for c in DOCS.split(", ")]),
                              spark.createDataFrame([], DOCS))):
        d = str(tmp_path / str(n))
        docs.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
            f"{d}/labels.parquet")
        out = corpus_pipeline.run(spark, d)
        assert tuple(out.columns) == corpus_pipeline.PIECE_COLUMNS
        assert (out.count() > 0) == (n == 0)
