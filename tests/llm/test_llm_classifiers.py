"""Quality network, toxicity machine and language mixture."""

import random
import zlib

import numpy as np
import pytest
from helpers import LONG, ODD_ROWS, documents, empty_like, odd_documents, with_clashes

from curato.llm import language_id as L
from curato.llm import quality_classifier as Q
from curato.llm import toxicity as T
from curato.llm.common import fit_sample, pieces, table

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def auc(y, s):
    y, order = np.asarray(y), np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def packed(texts):
    return T._packed([t.encode() for t in texts])


def test_sample_leaves_out_held_out_rows_and_keeps_the_bound(spark):
    df = documents(spark, [(i, f"text {i}") for i in range(200)])
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(200)] + [(3, 1, 0), (None, 1, 0), (999, 1, 1)])
    got = fit_sample(df, labels, "quality", 40)
    assert 38 <= len(got) <= 40 and all(sum(y == v for _, y, _ in got) <= 20 for v in (0, 1))  # one label has no document
    assert all(not held(int(t.split()[1])) for t, _, _ in got)
    assert fit_sample(df, empty_like(labels), "quality", 40) == []
    assert fit_sample(empty_like(df), labels, "quality", 40) == []


def test_pieces_cover_every_byte():
    raw, offsets = packed(["", "ab cd " * 50, "", "x" * 300, "é" * 7])
    for limit in (16, 64, 10_000):
        got, last = b"", -1
        for first, part, offs in pieces(raw, offsets, limit):
            assert first >= last and len(part) <= limit and offs[-1] == len(part)
            got, last = got + part.tobytes(), first
        assert got == raw.tobytes()


@pytest.fixture(scope="module")
def junk_and_prose():
    rng = random.Random(2)
    words = ["river", "stone", "house", "under", "light", "of", "the", "a", "small", "green"]
    out = []
    for i in range(240):
        w = rng.choices(words, k=rng.randint(3, 200))
        out.append((" ".join(x + "$$$" for x in w) if i % 3 == 0 else " ".join(w) + ".", int(i % 3 != 0)))
    return out


def test_network_learns_and_covers_whole_texts(junk_and_prose):
    net = Q.learn([(t.encode(), y, 1.0) for t, y in junk_and_prose[:160]])
    test = junk_and_prose[160:]
    s = net.scores(*packed([t for t, _ in test]))
    assert auc([y for _, y in test], s) > 0.98 and ((s >= 0) & (s <= 1)).all()
    # Junk anywhere in a long text lowers its score; where the text lies in a batch does not matter.
    prose = " ".join(t for t, y in test if y) * 20
    tail = prose + " " + " ".join(t for t, y in test if not y) * 20
    many = net.scores(*packed(["", prose, "x", tail]))
    assert many[3] < many[1]
    for t, v in zip(["", prose, "x", tail], many, strict=True):
        assert net.scores(*packed([t]))[0] == pytest.approx(v, abs=1e-6)


def test_training_sees_every_chunk():
    rng = np.random.default_rng(3)
    for size in (0, 1, 511, 512, 513, 5000, 60_000, 1_000_000):
        every = set(range(0, max(1, size - Q.BLOCK), Q.BLOCK))
        starts = Q._chunk_starts(size, rng)
        assert len(starts) == Q.EPOCHS and {int(x) for s in starts for x in s} == every
        assert max(map(len, starts)) <= max(Q.TRAIN_CHUNKS, -(-len(every) // Q.EPOCHS))
    # The one mark of a class lies in the middle of long texts.
    rows = []
    for i in range(120):
        words = ["plain"] * 3000
        words[1500:1500] = ["qqqqq"] * 60 if i % 2 else []
        rows.append((" ".join(words).encode(), i % 2, 1.0))
    net = Q.learn(rows)
    s = net.scores(*packed([t.decode() for t, _, _ in rows[:20]]))
    assert auc([y for _, y, _ in rows[:20]], s) == 1.0


def naive_score(net, text):
    """The network written out: one position, one tap at a time."""
    raw = text.encode()
    blocks = max(1, -(-len(raw) // Q.BLOCK))
    pooled = []
    for c in range(max(1, blocks - 1)):
        part = range(c * Q.BLOCK, min(len(raw), c * Q.BLOCK + Q.CHUNK))
        best = [max([sum(net.taps[f, j, raw[p + j]] for j in range(Q.WIDTH) if p + j < len(raw)) for p in part], default=0)
                for f in range(Q.FILTERS)]
        pooled.append(np.maximum(np.array(best) + net.offset, 0))
    z = np.mean(pooled, axis=0) @ net.combine + net.bias
    return 1 / (1 + np.exp(-z))


def test_network_equals_the_written_out_one(junk_and_prose, monkeypatch):
    net = Q.learn([(t.encode(), y, 1.0) for t, y in junk_and_prose[:60]])
    texts = ["", "a", "ab é", "z" * 255, "z" * 256, "y" * 257, junk_and_prose[1][0][:512], junk_and_prose[4][0] * 2]
    got = net.scores(*packed(texts))
    assert got == pytest.approx([naive_score(net, t) for t in texts], abs=1e-5)
    monkeypatch.setattr(Q, "PIECE", 2 * Q.BLOCK)
    assert net.scores(*packed(texts)) == pytest.approx(got, abs=1e-6)


def test_machine_learns_pairs_that_weights_cannot():
    """Toxic only when an insult meets a group; either alone is not."""
    rng = random.Random(4)
    filler = [f"filler{i}" for i in range(30)]
    rows = []
    for i in range(600):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(filler, k=12) + ["vermin"] * insult + ["islanders"] * group
        rng.shuffle(words)
        rows.append((" ".join(words).encode(), int(insult and group), 1.0))
    m = T.learn(rows[:450])
    s = m.scores(*T._packed([t for t, _, _ in rows[450:]]))
    y = np.array([y for _, y, _ in rows[450:]])
    assert ((s >= 0.5) == y).mean() > 0.97
    a, b = m.scores(*packed(["vermin here", "vermin islanders"]))
    assert a < 0.5 < b


def test_machine_learns_terms_that_say_nothing_alone():
    """Toxic when an insult and a group are both there or both absent: neither tells the classes apart by itself."""
    rng = random.Random(4)
    filler = [f"filler{i}" for i in range(30)]
    rows = []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(filler, k=12) + ["insult"] * insult + ["group"] * group
        rng.shuffle(words)
        rows.append((" ".join(words).encode(), int(insult == group), 1.0))
    m = T.learn(rows[:1100])
    s = m.scores(*T._packed([t for t, _, _ in rows[1100:]]))
    y = np.array([y for _, y, _ in rows[1100:]])
    assert ((s >= 0.5) == y).mean() > 0.95


def test_machine_pair_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = T.Machine(np.full(1 << T.BUCKET_BITS, -1, np.int16), 0.3, rng.normal(size=9), rng.normal(size=(9, T.FACTORS)))
    x = (rng.random((20, 9)) < 0.5).astype(float)
    naive = [0.3 + sum(m.weight[i] for i in np.flatnonzero(r)) + sum(
        m.factor[i] @ m.factor[j] for i in np.flatnonzero(r) for j in np.flatnonzero(r) if i < j) for r in x]
    assert m.logits(x) == pytest.approx(naive)


def test_machine_reads_long_texts_in_pieces(monkeypatch):
    rng = random.Random(2)
    rows = [(" ".join(rng.choices(["good", "vermin", "river", "stone"], k=30)).encode(), i % 2, 1.0) for i in range(80)]
    m = T.learn([(t + b" awful" * y, y, w) for t, y, w in rows])
    texts = ["", "river " * 3000 + "awful", "stone", "good awful " * 500]
    whole = m.scores(*packed(texts))
    monkeypatch.setattr(T, "PIECE", 64)
    assert m.scores(*packed(texts)) == pytest.approx(whole, abs=1e-9)


def test_mixture_finds_the_languages_of_a_document():
    rng = random.Random(6)
    vocab = {k: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(80)]
             for k, letters in {"aa": "abcdefgh", "bb": "hijklmno", "cc": "opqrstuv"}.items()}

    def text(lang, n):
        return " ".join(rng.choices(vocab[lang], k=n))

    model = L.learn([(text(k, 120).encode(), k) for k in vocab for _ in range(20)])
    texts = [text("aa", 60), text("bb", 3), text("aa", 150) + " " + text("cc", 60), text("cc", 4000)]
    pred, score, size = model.predict(*packed(texts))
    assert [model.langs[p] for p in pred] == ["aa", "bb", "aa", "cc"]
    assert list(size) == [1, 1, 2, 1] and 0.6 < score[2] < 0.8
    # EM against a plain loop over one document.
    counts = model.counts(*packed(texts[2:3]))[:, 1:] / L.GRAM
    p, share = model.chance[1:][:, [0, 2]], np.array([0.5, 0.5])
    for _ in range(L.ROUNDS):
        r = p * share / (p @ share)[:, None]
        share = counts[0] @ r / counts.sum()
    assert score[2] == pytest.approx(share.max())


def every_addition(model, counts):
    """The search written out: each round fits every language that is not in the set yet."""
    counts = counts[1:] / L.GRAM
    chance = model.chance[1:]
    single = counts @ np.log(chance)
    chosen, share = [int(single.argmax())], np.ones(1)
    best = single[chosen[0]]
    while counts.sum() and len(chosen) < len(model.langs):
        tried = []
        for lang in sorted(set(range(len(model.langs))) - set(chosen)):
            p, s = chance[:, [*chosen, lang]], np.full(len(chosen) + 1, 1 / (len(chosen) + 1))
            for _ in range(L.ROUNDS):
                s = (counts / (p @ s)) @ p * s / counts.sum()
            tried.append((counts @ np.log(p @ s), -lang, s))
        ll, lang, s = max(tried, key=lambda t: t[:2])
        if ll - best <= L.PENALTY + 0.5 * np.log(max(1, counts.sum())):
            break
        chosen, share, best = [*chosen, -lang], s, ll
    return chosen[int(share.argmax())], share.max(), len(chosen)


@pytest.mark.parametrize("langs", [1, 2, 5, 25])
def test_bounds_lose_no_addition(langs):
    rng = random.Random(langs)
    letters = "abcdefghijklmnopqrstuvwxyz"
    shared = ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(80)]
    vocab = {f"l{i:02}": rng.sample(shared, 30) + ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(60)]
             for i in range(langs)}
    model = L.learn([(" ".join(rng.choices(vocab[k], k=80)).encode(), k) for k in vocab for _ in range(10)])
    texts = [" ".join(" ".join(rng.choices(vocab[rng.choice(list(vocab))], k=rng.choice([2, 15, 90])))
                      for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(40)]
    pred, score, size = model.predict(*packed(texts))
    for i, c in enumerate(model.counts(*packed(texts))):
        want = every_addition(model, c)
        assert (pred[i], size[i]) == (want[0], want[2]) and score[i] == pytest.approx(want[1])
    assert langs == 1 or size.max() > 1


def test_counting_on_the_executors_learns_the_same(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    docs = docs.unionByName(docs.limit(30))
    sample = [(bytes(r.text), r.lang) for r in L.language_sample(docs, 40).collect()]
    a, b = L.learn(sample), L.learn_languages(docs, 40)
    assert a.langs == b.langs and a.common == b.common
    assert (a.symbol == b.symbol).all() and (a.chance == b.chance).all()
    assert L.learn_languages(empty_like(docs)) is None
    m, k = T.learn(fit_sample(docs, labels, "toxic", 400)), T.learn_toxicity(docs, labels, bound=400)
    assert (m.place == k.place).all() and len(k.weight) > 20
    assert m.weight == pytest.approx(k.weight, abs=1e-3) and m.bias == pytest.approx(k.bias, abs=1e-3)


def test_partial_counts_depend_on_the_texts_not_on_the_partitions(spark):
    sample = L.language_sample(table(spark, SF, "documents"), 40)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before, found = [spark.conf.get(n) for n in names], []
    try:
        spark.conf.set(names[1], "false")
        for parts in ("2", "120"):
            spark.conf.set(names[0], parts)
            found.append([tuple(r) for r in L._partial_counts(sample).collect()])
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
    few, many = found
    cells = {(lang, bucket) for lang, bucket, _ in few}
    assert cells == {(lang, bucket) for lang, bucket, _ in many}
    assert sum(n for _, b, n in few if b >= 0) == sum(n for _, b, n in many if b >= 0)
    assert max(sum(1 for lang, b, _ in many if b < 0 and lang == x) for x in {lang for lang, _ in cells}) <= L.SLICES
    assert len(many) <= L.SLICES * len(cells)


@pytest.mark.parametrize("others", [9, 10, 20])
def test_close_languages_stay_apart_at_any_number_of_languages(others):
    rng = random.Random(8)
    # Each word of a, b and c is in two of them, so only the pair of its languages tells them apart.
    both = {x: [f"{x[0]}{''.join(rng.choices(letters, k=5))}" for _ in range(40)]
            for x, letters in {"ab": "abcdef", "ac": "ghijkl", "bc": "mnopqr"}.items()}
    vocab = {x: [w for k, v in both.items() if x in k for w in v] for x in "abc"}
    vocab |= {f"z{i:02}": ["".join(rng.choices("stuvwxyz", k=6)) for _ in range(40)] for i in range(others)}
    model = L.learn([(" ".join(rng.choices(vocab[k], k=100)).encode(), k) for k in vocab for _ in range(15)])
    names = [k for k in "abc" for _ in range(200)]
    pred, _, _ = model.predict(*packed([" ".join(rng.choices(vocab[k], k=4)) for k in names]))
    assert np.mean([model.langs[p] == k for p, k in zip(pred, names, strict=True)]) > 0.92


def test_language_sample_counts_a_repeated_id_once(spark):
    ids = [i for i in range(200) if not held(i)]
    rows = [(i, f"text {i} {j}", "aa") for i in ids[:40] for j in range(30)]        # every id repeats
    rows += [(i, f"text {i}", "bb") for i in ids[40:80]]
    rows += [(i, f"copy {j:04}", f"l{i}") for i in ids[80:84] for j in range(500)]   # one id is the language
    got = [(bytes(r.text), r.lang) for r in L.language_sample(documents(spark, rows), 10).collect()]
    texts = {lang: [t.decode() for t, x in got if x == lang] for _, lang in got}
    assert {k: len(v) for k, v in texts.items()} == {"aa": 10, "bb": 10} | {f"l{i}": 1 for i in ids[80:84]}
    assert all(t.endswith(" 0") for t in texts["aa"]) and len(set(texts["aa"])) == 10
    assert all(texts[f"l{i}"] == ["copy 0000"] for i in ids[80:84])


@pytest.mark.parametrize("kind", ["quality", "toxic", "lang"])
def test_odd_rows_and_empty_tables(spark, kind):
    df = odd_documents(spark)
    extra = with_clashes(df, "score", "held_out", "predicted", "lang_pred", "letters")
    labels = labels_of(spark, [(i, i % 2, (i + 1) % 2) for i in (2, 4, 5, 7, 8, 9)])

    def run(docs, labs):
        if kind == "quality":
            return Q.score_documents(docs, Q.learn(fit_sample(docs, labs, "quality", 100)))
        if kind == "toxic":
            return T.score_documents(docs, T.learn_toxicity(docs, labs, bound=100))
        return L.identify(docs, L.learn_languages(docs))

    a, b = run(df, labels).collect(), run(extra, labels).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == len(ODD_ROWS)
    assert all(0 <= r.score <= 1 and r.held_out == held("" if r.doc_id is None else r.doc_id) for r in a)
    if kind == "lang":
        assert {r.lang_pred for r in a if r.doc_id in (1, 2, 3, -3)} == {"und"}
    assert run(empty_like(df), empty_like(labels)).count() == 0
    none = run(df, empty_like(labels)).collect() if kind != "lang" else L.identify(df, None).collect()
    assert all(r.score == pytest.approx(0, abs=1e-9) for r in none)


def test_quality_stage_keeps_columns_and_accepted_rows(spark, junk_and_prose):
    net = Q.learn([(t.encode(), y, 1.0) for t, y in junk_and_prose[:160]])
    df = with_clashes(documents(spark, [(i, t) for i, (t, _) in enumerate(junk_and_prose)] + [(900, None), (901, LONG)]), "score")
    kept = Q.quality_stage(df, net)
    want = {r.doc_id for r in Q.score_documents(df, net).collect() if r.predicted}
    assert kept.schema == df.schema and {r.doc_id for r in kept.collect()} == want
    assert Q.quality_stage(empty_like(df), net).count() == 0


def test_held_out_accuracy_on_the_tables(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    lab = {r.doc_id: r for r in labels.collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    q = [r for r in Q.op2_quality_classifier(spark, SF).collect() if r.held_out and r.doc_id in lab]
    assert auc([lab[r.doc_id].quality for r in q], [r.score for r in q]) > 0.93
    x = [r for r in L.op4_language_id(spark, SF).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in x]) > 0.97
    t = [r for r in T.op6_toxicity(spark, SF).collect() if r.held_out and r.doc_id in lab]
    assert auc([lab[r.doc_id].toxic for r in t], [r.score for r in t]) > 0.75
