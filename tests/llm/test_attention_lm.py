import collections
import math

import numpy as np
import public_tokenizers
import pytest

from tradeflow.llm import attention_lm as lm

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = lm.read_ranks(PATH)
CODEC = lm._codec(RANKS, PATTERN)
ENC = CODEC.encoding
END = len(RANKS.splitlines())


def sequence(text):
    return [i for w in text.encode().lower().split() for i in ENC.encode_ordinary(" " + w.decode())] + [END]


@pytest.fixture(scope="module")
def model():
    texts = ["the cat sat on the mat and the dog ran to the house"] * 30 + ["a red fish and a blue fish swam in the sea"] * 30
    ids = [np.array(sequence(t)) for t in texts]
    return lm.fit(ids, np.bincount(np.concatenate(ids), minlength=END + 1), END, steps=60)


def plain_score(m, ids):
    """One position after the other, without windows in batches."""
    inputs = [m.end, *ids[:-1]]
    total = 0.0
    for t, want in enumerate(ids):
        low = max(0, (t // lm.STRIDE) * lm.STRIDE - lm.CONTEXT)
        x = m.symbol[np.array(inputs[low : t + 1])]
        s = m.key[x].astype(float) @ m.query[x[-1]] + m.bias[np.arange(len(x))[::-1]]
        a = np.exp(s) / np.exp(s).sum()
        logits = (a @ m.value[x]) @ m.out + m.own[x[-1]]
        total += (logits[m.group[want]] - np.log(np.exp(logits).sum())) / math.log(10) + m.within[want]
    return total


def test_batched_windows_score_every_token_once(model):
    texts = ["", "the cat", "the dog and the cat sat in the house " * 9, "zebra quartz", "fish " * 50]
    ids = [np.array(sequence(t)) for t in texts]
    got = model.score(np.concatenate(ids), np.array([len(i) for i in ids]))
    assert np.allclose(got, [plain_score(model, list(i)) for i in ids], rtol=1e-4)


def test_distribution_sums_to_one(model):
    assert np.bincount(model.group, weights=10.0 ** model.within.astype(float), minlength=lm.CLASSES) == pytest.approx(np.ones(lm.CLASSES), abs=1e-4)


def test_training_lowers_the_loss():
    texts = [np.array(sequence(t)) for t in ["one two three four five six seven eight", "red green blue red green blue"] * 40]
    counts = np.bincount(np.concatenate(texts), minlength=END + 1)
    flat, n = np.concatenate(texts), np.array([len(t) for t in texts])
    before, after = (lm.fit(texts, counts, END, steps=s).score(flat, n).sum() for s in (0, 80))
    assert after > before


def test_gradients_by_differences():
    """One Adam step moves every table against the numeric gradient."""
    rng = np.random.default_rng(0)
    p = {"query": rng.normal(size=(5, lm.WIDTH)), "key": rng.normal(size=(5, lm.WIDTH)), "value": rng.normal(size=(5, lm.WIDTH)), "out": rng.normal(size=(lm.WIDTH, 4)), "own": rng.normal(size=(5, 4)), "bias": np.zeros(24)}
    source, target = rng.integers(0, 5, 26), rng.integers(0, 4, 26)

    def loss(q):
        total, rows = 0.0, 0
        for at in (0, 1):
            x, y = source[at : at + 24], target[at : at + 24]
            for t in range(24):
                s = q["key"][x[: t + 1]] @ q["query"][x[t]] / np.sqrt(lm.WIDTH) + q["bias"][np.arange(t + 1)[::-1]]
                a = np.exp(s - s.max())
                logits = (a / a.sum() @ q["value"][x[: t + 1]]) @ q["out"] + q["own"][x[t]]
                total += np.log(np.exp(logits).sum()) - logits[y[t]]
                rows += 1
        return total / rows

    before = loss(p)
    lm._descend(p, source, target, 24, np.random.default_rng(1), 25)
    assert loss(p) < before - 0.1


def brute(texts, train):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    c = collections.Counter(w for i, ws in tokens.items() if train[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens.items()}


@pytest.mark.parametrize("segment_bytes", [10_000_000, 3_000])
def test_corpus_counts_equal_brute_force(spark, docs_of, awkward, segment_bytes):
    texts = dict(enumerate([*awkward, "A b Ü ü", "new words only", "a b c"]))
    train = {i: i % 3 != 1 for i in texts}
    docs = docs_of(list(texts.values())).withColumn("train", spark_mod(3) != 1)
    got = {r.doc_id: r for r in lm.score_documents(docs, PATH, PATTERN, segment_bytes=segment_bytes, segment_growth=1, steps=5).collect()}
    assert len(got) == len(texts)
    for i, (n, known, total, base) in brute(texts, train).items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base) and got[i].score < 0


def spark_mod(n):
    from pyspark.sql import functions as F

    return F.col("doc_id") % n


def test_nothing_to_learn_from_and_empty_tables(docs_of):
    from pyspark.sql import functions as F

    rows = lm.score_documents(docs_of(["a b", None]).withColumn("train", F.lit(False)), PATH, PATTERN, steps=5).collect()
    assert [(r.train_tokens, r.n_known) for r in rows] == [(0, 0)] * 2 and all(r.base_score == 0 and r.score < 0 for r in rows)
    assert lm.score_documents(docs_of([]).withColumn("train", F.lit(True)), PATH, PATTERN, steps=5).count() == 0


def test_subwords_of_odd_words():
    own = lm.Words.of(["a\xa0 b\xa0c 漢字 \x1c it's x" + "y" * 2_500])
    ids, starts = own.subwords(CODEC)
    for k, w in enumerate(own.distinct):
        assert b"".join(ENC.decode_bytes([i]) for i in ids[starts[k] : starts[k + 1]]) == b" " + w


def test_long_words_have_the_ids_of_the_library():
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdeé漢"), 3_000)), "x" * 1_500 + "\u6f22" * 1_200, "short"]
    own = lm.Words.of([" ".join(words)])
    ids, starts = own.subwords(CODEC)
    for k, word in enumerate(words):
        assert ids[starts[k] : starts[k + 1]].tolist() == ENC.encode_ordinary(" " + word)


def test_held_out_texts_score_above_the_unigram_base(spark, docs_of):
    """Sentences of a small grammar: word order and the corpus' words both tell something."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(12)
    who, does, what = ["the cat", "a dog", "my aunt", "our king"], ["sees", "likes", "paints", "sells"], ["red apples", "old ships", "a house", "the moon"]
    texts = [" ".join(f"{rng.choice(who)} {rng.choice(does)} {rng.choice(what)} ." for _ in range(rng.integers(1, 12))) for _ in range(400)]
    texts += [" ".join(f"rare{rng.integers(40)}" for _ in range(30)) for _ in range(40)]
    docs = docs_of(texts).withColumn("train", F.col("doc_id") % 5 != 0)
    rows = lm.score_documents(docs, PATH, PATTERN, steps=120).filter("NOT train").collect()
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)
    assert all(r.score >= r.base_score - math.log10(2) - 1e-9 for r in rows)


def test_all_training_texts_shape_the_model(docs_of):
    """The same words in another order, in texts beyond any fixed number of them, change what a text's order is worth."""
    from pyspark.sql import functions as F

    forward, seen = "alpha beta gamma delta " * 5, "red green blue"
    rows = {}
    for name, rest in (("same", forward), ("reversed", " ".join(reversed(forward.split())))):
        docs = docs_of([forward, *[seen] * 4_000, *[rest] * 40])
        # The texts in question come last in the order of hashed ids.
        order = docs.select("doc_id").orderBy(F.xxhash64("doc_id").desc()).limit(41).collect()
        last = [r.doc_id for r in order]
        text = F.when(F.col("doc_id") == last[0], forward).when(F.col("doc_id").isin(last[1:]), rest).otherwise(seen)
        docs = docs.withColumn("text", text).withColumn("train", F.col("doc_id") != last[0])
        rows[name] = lm.score_documents(docs, PATH, PATTERN, steps=60).filter("NOT train").first()
    assert rows["same"].base_score == pytest.approx(rows["reversed"].base_score)
    assert rows["same"].score > rows["reversed"].score + 1


def test_scores_are_the_same_for_any_partitioning(docs_of, spark):
    from pyspark.sql import functions as F

    texts = [f"the {w} cat sat on the {w} mat {i}" for i, w in enumerate(["red", "blue", "old"] * 60)]
    docs = docs_of(texts).withColumn("train", F.col("doc_id") % 4 != 0)
    scores = []
    for width in ("1", "7"):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1g" if width == "1" else "1k")
        try:
            found = lm.score_documents(docs.repartition(int(width)), PATH, PATTERN, segment_bytes=1_000, segment_growth=1, steps=10)
            scores.append({r.doc_id: (r.base_score, r.score) for r in found.collect()})
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert scores[0] == scores[1]


def test_counts_over_pieces_equal_those_of_one_run_of_texts(docs_of, spark):
    from pyspark.sql import functions as F

    texts = [f"the {w} cat sat on the {w} mat {i % 7}" for i, w in enumerate(["red", "blue", "old"] * 30)]
    docs = docs_of(texts).withColumn("train", F.col("doc_id") % 4 != 0)
    ranks = spark.sparkContext.broadcast(RANKS)
    stored = lm.word_counts(lm._dealt(docs, 5), 5, ranks, PATTERN).filter("kind = 3").cache()
    ids = [np.array(sequence(t)) for i, t in enumerate(texts) if i % 4 != 0]
    counts = np.bincount(np.concatenate(ids), minlength=END + 1)
    symbols, group = lm.Symbols.of(counts, END), np.arange(END + 1) % lm.CLASSES

    def neighbours(total, own, _):
        total += symbols.neighbours(own.training())

    def preferences(total, own, _):
        total += symbols.preferences(own.training(), group)

    size = 2 * len(symbols.top) * symbols.near
    assert (lm._over_pieces(stored, END, size, neighbours) == sum(symbols.neighbours(x) for x in ids)).all()
    size = (lm.OWN_SYMBOLS + lm.SHARED + 1) * lm.CLASSES
    assert (lm._over_pieces(stored, END, size, preferences) == sum(symbols.preferences(x, group) for x in ids)).all()
    stored.unpersist()


def test_words_are_told_from_their_subwords():
    rng = np.random.default_rng(3)
    own = lm.Words.of([" ".join(["a\xa0", "b\xa0c", "漢字", "\x1c", "ab", "ba", "x" * 9_000, "x" * 9_001, "xy" * 4_500, *{str(x) for x in rng.integers(0, 10**7, 50_000)}])])
    ids, starts = own.subwords(CODEC)
    hashes = lm.word_hashes(ids, starts[:-1])
    assert len(set(hashes.tolist())) == len(own.distinct)
    again = ids.astype(lm._kind(END))
    assert (np.flatnonzero(lm._opens(ENC)[again]) == starts[:-1]).all() and (lm.word_hashes(again, starts[:-1]) == hashes).all()


def test_words_found_in_one_buffer_equal_those_of_split(monkeypatch):
    monkeypatch.setattr(lm, "LOOK_BYTES", 64)
    texts = ["", " \n\t ", "a\x1cb \x1d c", "\x0b\x0ca\r\nb ", "É\xa0É x　 Ab\x85c", "x\x00y x\x00 x", "q" * 50 + " " + "q" * 49 + " qqqqqqqq " + "q" * 9, "z" * 5_000 + " " + "z" * 4_999, "A b a B"]
    own, want = lm.Words.of(texts), [t.encode().lower().split() for t in texts]
    ends = np.cumsum([0, *own.lengths])
    assert [[own.distinct[i] for i in own.numbers[a:b]] for a, b in zip(ends[:-1], ends[1:], strict=True)] == want
    assert len(set(own.distinct)) == len(own.distinct)


def test_a_segments_pieces_go_through_each_window_once(monkeypatch):
    """Pieces are of like size, so that none is gone through again only because it is a rest."""
    texts = ["the red cat sat on the old blue mat"] * 200
    own = lm.Words.of(texts)
    ids, starts = own.subwords(CODEC)
    monkeypatch.setattr(lm, "PIECE_WORDS", 500)
    pieces = list(lm._pieces(own, ids, starts, END))
    sizes = [int(own.lengths[low:high].sum()) for low, high, *_ in pieces]
    assert sum(sizes) == 1_800 and [p[0] for p in pieces[1:]] == [p[1] for p in pieces[:-1]] and max(sizes) - min(sizes) <= 2 * 9
    assert sum(len(p[2]) for p in pieces) == sum(len(sequence(t)) for t in texts)
    monkeypatch.undo()
    # A full piece, of which six texts of seven are learnt from: its windows make more steps than ``STEPS``, so none comes twice.
    seen = []
    monkeypatch.setattr(lm, "_steps", lambda p, source, target, span, batches, rates, moved: seen.extend(np.concatenate(batches)))
    for round_ in range(lm.ROUNDS):
        lm.learn({}, source := np.zeros(lm.PIECE_WORDS * 2 * 6 // 7, np.int64), source, round_, lm.STEPS, np.random.default_rng(1))
    assert len(seen) == len(set(seen)) == -(-len(source) // (lm.CONTEXT + lm.STRIDE))
