"""Components, caps, the n-gram join and the pipeline, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import byte_cnn, embed_caps, line_runs, ngram_join, queries, shingles
from millrace.llm.components import components


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(300)]
    names = list(range(1000, 1400))
    rng.shuffle(names)
    links = chain + list(zip(names, names[1:], strict=False)) + [(5000, 5000 + i) for i in range(1, 200)] + [(7, 7), (9000, 9001)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.id: r.component for r in components(df).collect()}
    assert got == brute_components({x for a, b in links for x in (a, b)}, links)
    assert components(df.filter("a < 0")).count() == 0


def test_caps_find_what_brute_force_finds(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 24))
    near = np.concatenate([base[i % 40] + rng.normal(size=24) * s for i, s in enumerate(np.linspace(0.01, 0.6, 300))]).reshape(300, 24)
    hot = base[0] + rng.normal(size=(150, 24)) * 0.02
    x = np.concatenate([base, near, hot, np.repeat(base[:3], 30, axis=0)]).astype(np.float32)
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    comp = brute_components(range(len(x)), zip(*np.nonzero(linked), strict=True))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    block, embed_caps.BLOCK = embed_caps.BLOCK, 40
    try:
        out = {r.vec_id: r for r in embed_caps.near_components(df).collect()}
    finally:
        embed_caps.BLOCK = block
    missed = sum(int(linked[i].sum()) - out[i].n_links for i in range(len(x)))
    assert all(out[i].n_links <= linked[i].sum() for i in out) and missed <= 0.002 * linked.sum()
    assert np.mean([out[i].component_id == comp[i] for i in out]) > 0.995


def test_caps_ignore_bad_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [1.0, 0.0])]
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_caps.near_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert out == {1: (2, 1, True), 2: (2, 1, False), 7: (2, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (0, 6, True)}


def word_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute_join(docs, width, percent):
    sets = {}
    for i, t in docs:
        sets[i] = word_set(t, width)
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = brute_components(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    docs, passage = [], " ".join(rng.choice(words) for _ in range(30))
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 20, 60, 120]))]
        for _ in range(rng.choice([1, 2, 6, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy) + ((" " + passage) if rng.random() < 0.4 else "")
            docs.append(text.title() if rng.random() < 0.2 else text)
    return list(enumerate([*docs, None, "", "one", "One", "two words", " \t\n", passage, passage]))


def test_join_equals_brute_force(spark):
    for seed, width, percent in ((1, 3, 90), (2, 5, 80), (3, 3, 80)):
        docs = near_copies(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash"))
        out = ngram_join.near_components(df, params=ngram_join.Params(width, percent)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_join(docs, width, percent)


def test_join_with_small_slots(spark):
    slot, ngram_join.SLOT = ngram_join.SLOT, 3
    try:
        docs = near_copies(5)
        out = ngram_join.near_components(spark.createDataFrame(docs, "doc_id long, text string"), params=ngram_join.Params(3, 90)).collect()
    finally:
        ngram_join.SLOT = slot
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_join(docs, 3, 90)


def test_links_equal_brute_force(spark):
    """Also the links between members of one component, which the components leave out."""
    for seed, width, percent, block in ((1, 3, 90, 512), (2, 5, 80, 3)):
        docs = near_copies(seed)
        sets = {i: frozenset(word_set(t, width)) for i, t in docs}
        pairs = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
        rep = {i: min(k for k in sets if sets[k] == sets[i]) if sets[i] else i for i in sets}
        old, ngram_join.BLOCK = ngram_join.BLOCK, block
        try:
            links, members = ngram_join.near_links(spark.createDataFrame(docs, "doc_id long, text string"), params=ngram_join.Params(width, percent))
        finally:
            ngram_join.BLOCK = old
        assert sorted((r.a, r.b) for r in links.collect()) == sorted({(a, b) for a, b in pairs if rep[a] == a and rep[b] == b and sets[a] != sets[b]})
        want = {i: (len(sets[i]), rep[i], sum(i in pair for pair in pairs)) for i in sets}
        assert {r.doc_id: (r.n_shingles, r.rep_id, r.n_links) for r in members.collect()} == want


def test_shingles_in_pieces():
    text = (" ".join(f"w{i % 97}é" for i in range(4000)) + " x" * 50 + " " + "y" * 700).encode()
    whole, chunk = shingles.word_hashes(text), shingles._CHUNK
    shingles._CHUNK = 256
    try:
        assert (shingles.word_hashes(text) == whole).all()
    finally:
        shingles._CHUNK = chunk
    assert len(whole) == 4001 and len(shingles.shingle_set(b"a b", 3)) == 1 and not len(shingles.shingle_set(b" \t ", 3))
    assert (shingles.shingle_set(b"A B c", 2) == shingles.shingle_set(b"a b\nC", 2)).all()


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = set(docs.columns)
    texts = {r.doc_id: r.text for r in docs.collect()}

    kept = cp.quality(spark, docs, sf_dir)
    model = byte_cnn.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    want = {i for i, t in texts.items() if byte_cnn.probability(t.encode(), model) >= 0.5}
    assert set(kept.columns) == columns and {r.doc_id for r in kept.collect()} == want

    lines = cp.line_dedup(spark, docs, sf_dir)
    from tests.llm.test_scans import brute_lines

    assert set(lines.columns) == columns and sorted((r.doc_id, r.text) for r in lines.collect()) == [(i, t) for i, _, _, t in brute_lines(list(texts.items()), 40, 5)]

    near = cp.near_duplicates(spark, docs, sf_dir)
    assert set(near.columns) == columns and {r.doc_id for r in near.collect()} == {c for _, c in brute_join(list(texts.items()), 5, 80).values()}

    mixed = cp.mix_sources(spark, docs, sf_dir)
    assert set(mixed.columns) == columns and 0 < mixed.count() < len(texts)
    assert cp.encode(spark, mixed, sf_dir).filter("lossless").count() == mixed.count()


def test_pipeline_runs_and_is_registered(spark, sf_dir):
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert line_runs and "pipeline" in entry.queries()
    out = entry.queries()["pipeline"](spark, sf_dir)
    assert out.count() > 0 and {"doc_id", "ids", "n_pieces"} <= set(out.columns)


def test_recall_of_caps_at_the_threshold():
    """Random pairs at a cosine of exactly 0.9 share a cap, for few and many dimensions and vectors."""
    for d, n in ((3, 2_000), (8, 50_000), (64, 50_000), (768, 2_000)):
        p = embed_caps.Params()
        caps = embed_caps.Caps(n, {d: embed_caps.plan(n, d, p)}, p)
        rng = np.random.default_rng(5)
        one, two = rng.normal(size=(2, 400, d))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        two -= (one * two).sum(axis=1, keepdims=True) * one
        two = 0.9 * one + np.sqrt(1 - 0.81) * two / np.linalg.norm(two, axis=1, keepdims=True)
        met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(caps.of(one), caps.of(two), strict=True)]
        apart = np.bitwise_count((caps.signs(one) ^ caps.signs(two)).view(np.uint64)).sum(axis=1)
        assert np.mean(met) >= 0.99 and apart.max() <= embed_caps.most_apart(p)


def test_caps_of_a_vector_do_not_depend_on_its_batch():
    p = embed_caps.Params()
    caps = embed_caps.Caps(5_000, {}, p)
    x = np.random.default_rng(3).normal(size=(300, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code, books = embed_caps.plan(5_000, 20, p), None
    together, alone = caps.of(x), [caps.of(v[None])[0] for v in x]
    assert all((a == b).all() for a, b in zip(together, alone, strict=True))
    books = caps.books[20][1]
    for v, got in zip(x[:20], alone, strict=False):
        want = []
        for number, (rotation, words) in enumerate(books):
            turned = (np.pad(v, (0, len(rotation) - 20)) @ rotation).reshape(code.blocks, -1)
            sums = (words[0] @ turned[0])[:, None] + (words[1] @ turned[1])[None, :]
            want += [int(i * code.words + j) * p.codes + number for i, j in zip(*np.nonzero(sums / np.sqrt(2) >= code.height), strict=True)]
        assert sorted(want) == got.tolist()


def test_caps_of_many_vectors_stay_few():
    """For 15 million vectors: rows sent for each, and pairs of a cap that have no more in common than it but pass the sketches."""
    d, n, p = 64, 15_000_000, embed_caps.Params()
    code = embed_caps.plan(n, d, p)
    caps = embed_caps.Caps(n, {d: code}, p)
    x = np.random.default_rng(6).normal(size=(2, 20_000, d))
    x /= np.linalg.norm(x, axis=2, keepdims=True)
    assert np.mean([len(c) for c in caps.of(x[0, :300])]) <= 64
    x[:, :, 0] = 0
    x *= np.sqrt(1 - code.height**2) / np.linalg.norm(x, axis=2, keepdims=True)
    x[:, :, 0] = code.height
    apart = np.bitwise_count((caps.signs(x[0]) ^ caps.signs(x[1])).view(np.uint64)).sum(axis=1)
    assert np.mean(apart <= embed_caps.most_apart(p)) <= 1e-4


def test_labels_of_buckets_equal_brute_force():
    """Small buckets side by side and one that is searched row by row: near rows of a bucket share a label."""
    rng = np.random.default_rng(8)
    p = embed_caps.Params()
    signs = rng.integers(0, 2**63, size=(3_000, embed_caps.SIGNS // 64), dtype=np.uint64)
    for i in range(1, 2_000):  # copies of earlier rows, more and more apart
        if i % 3:
            flips = rng.random(embed_caps.SIGNS) < 0.2 * i / 2_000
            signs[i] = signs[i - 1 - int(rng.integers(min(i, 3)))] ^ np.packbits(flips).view(np.uint64)
    entries = np.zeros(3_000, embed_caps.ENTRY)
    entries["rep"], entries["signs"] = rng.permutation(3_000), signs
    entries["key"] = np.where(np.arange(3_000) < 1_200, 0, rng.integers(1, 90, 3_000))
    most, want = embed_caps.most_apart(p), set()
    first = embed_caps.FIRST_SIGNS // 64
    for key in range(90):
        rows = np.flatnonzero(entries["key"] == key)
        both = np.bitwise_count(signs[rows][:, None] ^ signs[rows][None])
        near = (both.sum(axis=2) <= most) & (both[:, :, :first].sum(axis=2) <= embed_caps.most_apart(p, embed_caps.FIRST_SIGNS))
        np.fill_diagonal(near, False)
        reps = entries["rep"][rows].tolist()
        label = brute_components(reps, [(reps[a], reps[b]) for a, b in zip(*np.nonzero(near), strict=True)])
        want |= {(label[r], r) for r, linked in zip(reps, near.any(axis=1).tolist(), strict=True) if linked}
    label, rep = embed_caps.near_labels(entries[rng.permutation(3_000)], p)
    assert set(zip(label.tolist(), rep.tolist(), strict=True)) == want and len(want) == len(rep) > 1_000


def test_large_caps_in_parts_give_the_same(spark, monkeypatch):
    """Caps dealt out in parts, in rounds of few codes and with contained labels left out: links and components as before."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(300, 16)), rng.normal(size=16) + rng.normal(size=(200, 16)) * 0.1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    comp = brute_components(range(len(x)), zip(*np.nonzero(linked), strict=True))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(embed_caps, "SPLIT", 40)
    monkeypatch.setattr(embed_caps, "LEAST_ROUND", 1 << 18)
    out = {r.vec_id: r for r in embed_caps.near_components(df).collect()}
    assert all(out[i].n_links <= linked[i].sum() for i in out) and sum(r.n_links for r in out.values()) >= 0.998 * linked.sum()
    assert np.mean([out[i].component_id == comp[i] for i in out]) > 0.99


def test_clashing_columns_change_nothing(spark):
    from millrace.llm import exact_dedup

    clash = ["key", "norm", "slot", "rank", "hot", "rep", "caps", "cap", "d", "copies", "token", "gid", "n", "node", "prefix", "parity", "s1", "id", "n_links", "kept", "keep_id", "component_id"]
    docs = spark.createDataFrame(near_copies(7), "doc_id long, text string")
    vectors = spark.createDataFrame([(i, [float(i % 3), 1.0, 0.05 * i]) for i in range(12)], "vec_id long, embedding array<float>")
    for f, df in ((exact_dedup.dedup, docs), (ngram_join.near_components, docs), (embed_caps.near_components, vectors)):
        wide = df.select("*", *[F.lit("clash").alias(c) for c in clash])
        plain, other = (sorted(map(str, f(x).collect())) for x in (df, wide))
        assert plain == other
