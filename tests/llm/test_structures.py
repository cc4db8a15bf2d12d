"""Vector codes, turn repair and packing against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import packing, queries, token_ids, turn_repair, vector_codes


# Turn repair


def cheapest(symbols):
    """(cost, audit) by trying all edits: best (cost, letters) of each (row, state), inserts included, first to last."""
    start, s, u, a = range(4)
    best = {start: (0, "")}

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for q, (c, t) in list(best.items()):
                to = a if q == u else u
                best[to] = min(best.get(to, (99999, "")), (c + 2, t + "I"))
        return best

    for initial, fault in symbols:
        new = {}

        def offer(q, c, t, new=new):
            new[q] = min(new.get(q, (99999, "")), (c, t))

        for q, (c, t) in inserted(best).items():
            offer(q, c + 3, t + "D")
            if fault < 2:
                to = a if q == u else u
                offer(to, c + 2 + fault, t + "R")
                if initial == "u" and to == u or initial == "a" and to == a:
                    offer(to, c + fault, t + "K")
                if initial == "s" and q == start:
                    offer(s, c + fault, t + "K")
        best = new
    best = inserted(best)
    return min(best[q] for q in (start, a) if q in best)


def test_every_short_conversation():
    automaton = turn_repair.Determinised()
    letters = [(i, f) for i in "suao" for f in (0, 1, 2)]
    for n in range(4):
        for symbols in itertools.product(letters, repeat=n):
            text = "".join(turn_repair.SYMBOLS["suao".index(i) * 4 + f] for i, f in symbols)
            assert automaton.repair(text) == cheapest(symbols), symbols
    assert len(automaton.vectors) < 100


def test_long_random_conversations():
    rng = np.random.default_rng(3)
    automaton = turn_repair.Determinised()
    for n in (10, 57, 400):
        for _ in range(20):
            symbols = [("suao"[rng.integers(4)], int(rng.choice([0, 0, 0, 1, 2]))) for _ in range(n)]
            text = "".join(turn_repair.SYMBOLS["suao".index(i) * 4 + f] for i, f in symbols)
            assert automaton.repair(text) == cheapest(symbols)


def brute_audit(rows):
    """rows in order of (turn, role, text), undamaged -> the report without its id."""
    order = sorted(((t is not None, t or 0, r or " " if r is None else r, x if x is not None else " ", t) for t, r, x in rows), key=lambda k: (k[0], k[1], k[2], k[3][:64], hashlib.sha256(k[3].encode()).hexdigest()))
    seen, symbols, faults = set(), [], Counter()
    for *_, role, text, _ in order:
        stripped = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 2 if not stripped else 3 if (role, text) in seen else 0 if stripped[-1] in ".!?" else 1
        seen.add((role, text))
        faults[fault] += 1
        symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "o", fault))
    cost, audit = cheapest([(i, min(f, 2)) for i, f in symbols])
    out, at = [], 0
    for letter in audit:
        role, text = (None, "") if letter == "I" else order[at][2:4]
        at += letter != "I"
        if letter != "D":
            out.append((letter, role, text))
    said = [f"{role if letter == 'K' else ('user', 'assistant')[(len(out) - i) % 2]}:{text}" for i, (letter, role, text) in enumerate(out)]
    turns = {t for t, *_ in rows if t is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(order)]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults[2], faults[3], faults[1], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


ODD = [
    *[(7, t, r, x) for t, r, x in [(0, "system", "Be kind."), (1, "user", "Hi?"), (1, "user", "Hi?"), (2, "assistant", "x" * 200_000), (5, "assistant", None), (None, None, "lost."), (None, "user", ""), (6, "tool", "out."), (6, "", "no role.")]],
    (8, None, None, None), (9, 3, "user", "Well?"), (9, 4, "assistant", "Ja. \n"), (None, 0, "assistant", "first!"), (None, 1, "assistant", "first!"), (-1, -(2**62), "user", "é\U0001f600."), (-1, 2**62, "assistant", "y."),
]


def test_turn_repair_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ODD], "conv_id long, turn long, role string, text string, head string")
    groups = defaultdict(list)
    for c, *r in ODD:
        groups[c].append(r)
    found = {r.conv_id: tuple(r)[1:] for r in turn_repair.audit(df).collect()}
    assert found == {c: brute_audit(rows) for c, rows in groups.items()}
    steps = turn_repair.repair(df).filter("role IS NOT NULL").orderBy("step").collect()
    for c, got in found.items():
        said = "\n".join(f"{r.role}:{r.text}" for r in steps if r.conv_id == c)
        assert hashlib.sha256(said.encode()).hexdigest() == got[-1]
    initials = {c: "".join(r.role[0] for r in steps if r.conv_id == c) for c in found}
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())


def test_one_conversation_over_many_partitions(spark):
    """A conversation that holds most rows is read in several range partitions and still is one."""
    rng = np.random.default_rng(4)
    rows = [(1, int(t), ("user", "assistant", "system")[rng.integers(3)], f"{rng.integers(900)}{'.' * int(rng.integers(2))}") for t in rng.permutation(3000)]
    rows += [(c, 0, "user", "a.") for c in range(2, 30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found = {r.conv_id: tuple(r)[1:] for r in turn_repair.audit(df).collect()}
    assert len(found) == 29 and found[1] == brute_audit([r[1:] for r in rows if r[0] == 1]) and found[5][5:7] == (2, "KI")


def test_dropped_conversations_stay(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b.")], "conv_id long, turn long, role string, text string")
    out = turn_repair.audit(df, damage=lambda c, t, r, x: (r, x, F.when(c == 1, 0).otherwise(1))).collect()
    assert {tuple(r) for r in out} == {(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()), (2, 0, 0, 0, 0, 0, 2, "KI", hashlib.sha256(b"user:b.\nassistant:").hexdigest())}


# Vector codes


@pytest.mark.parametrize("scale", [3, 900, 2**24])
def test_screening_is_exact(scale):
    rng = np.random.default_rng(5)
    entries = rng.integers(-scale, scale, (64, 9))
    entries[40:50] = entries[:10]  # equal entries: the first wins
    x = rng.integers(-scale, scale, (3000, 9))
    x[:1000] = (entries[rng.integers(64, size=1000)] + entries[rng.integers(64, size=1000)]) // 2  # as near to two
    screen = vector_codes.Screen(entries)
    index, error = screen.nearest(x)
    all_ = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == all_.argmin(axis=1)).all() and (error == all_.min(axis=1)).all()
    assert screen.evaluated < 3000 * 54  # most entries are ruled out unseen
    middle, radius = screen.intervals(x)
    exact = (screen.entries**2).sum(axis=1)[None, :] - 2 * (x @ screen.entries.T)
    assert (np.abs(middle - exact) <= radius).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -0.1, 0.0, 0.1], 1), (2, [0.5, 0.25, -0.1, 0.0, 0.1], None), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf], 1), (6, [None, 1.0], 1), (None, [1e30, -1e30], 1), (7, [], None), (1, [0.1], 2), (8, [0.5], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, code2 string")
    p = vector_codes.Params(entries=3, rounds=2)
    books = vector_codes.train(df, params=p)
    assert books.dim == 8 and books.parts[0].shape == (3, 2)
    kept = sorted(((i is None, i or 0, v), n) for n, (i, v, _) in enumerate(rows) if v is not None and all(x is not None and np.isfinite(x) for x in v))
    most = vector_codes.limit(8)
    x = np.zeros((len(kept), 8), np.int64)
    for k, ((_, _, v), _) in enumerate(kept):
        x[k, : len(v)] = np.clip(np.floor(np.array(v) * 1024), -most, most)
    codes, errors = [], 0
    for part in range(4):
        y = x[:, 2 * part : 2 * part + 2]
        c = y[:3].copy()
        for _ in range(p.rounds):
            near = ((y[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            for e in set(near.tolist()):
                c[e] = y[near == e].sum(axis=0) // (near == e).sum()
        d = ((y[:, None] - c[None]) ** 2).sum(axis=2)
        codes.append(d.argmin(axis=1))
        errors = errors + d.min(axis=1)
        assert (books.parts[part] == c).all()
    expected = sorted((str(rows[n][0]), bytes(z[k] for z in codes).hex(), int(errors[k]), rows[n][2]) for k, (_, n) in enumerate(kept))
    coded = vector_codes.with_group_error(vector_codes.encode(df, books, also=("label",)))
    got = coded.collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label) for r in got) == expected
    sums = Counter()
    for *_, e, label in expected:
        sums[label] += e
    assert all(r.label_error == sums[r.label] for r in got)
    back = vector_codes.decode(coded.filter("vec_id = 8"), books).first().vector
    assert len(back) == 8 and back[0] == books.parts[0][int(codes[0][[k for k, (_, n) in enumerate(kept) if n == 9][0]])][0] / 1024


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert vector_codes.train(df) is None and vector_codes.encode(df, None).count() == 0


# Packing


def whole_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(queries.word_tokenizer())
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


TEXTS = [
    "", " ", "Don't stop: it's 2024!!", "ÀÉ naïve façade, œuvre ½ µm ß ẞ", "a\x0bb\x0cc\x1cd\x85e f", "<|endoftext|>", "x<|startoftext|>y <|ENDOFTEXT|> <|", "é ́a 한국어 日本語 \U0001f600‍", "''s's'sT 'Ll I'LL",
    "tab\tnew\nline\r\nend", "#" * 500, "supercalifragilistic" * 300, "İstanbul ΣΑΣ ǅ", "12,345.67 £€ ÷×", "\x00 nul \x7f",
]


def test_ids_are_those_of_the_library(sf_dir, monkeypatch):
    import pyarrow.parquet as pq

    texts = TEXTS + [x for x in pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist() if x]
    monkeypatch.setattr(token_ids, "CHUNK", 50)
    encoder = token_ids.Encoder(queries.word_tokenizer())
    assert encoder.by_word
    for text, raw, ids in zip(texts, encoder.ids(texts), whole_ids(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == ids, text[:80]
    encoder.by_word = False
    assert encoder.ids(TEXTS) == [np.array(i, "<u4").tobytes() for i in whole_ids(TEXTS)]


def test_forgetting_words(monkeypatch):
    monkeypatch.setattr(token_ids, "REMEMBERED", 3)
    encoder = token_ids.Encoder(queries.word_tokenizer())
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(TEXTS)] == whole_ids(TEXTS)


def check_packed(rows, docs, capacity):
    """Every document is cut as it should be, and sequences are gapless and not too long."""
    wanted = Counter()
    for i, ids in docs:
        ids = [*ids, 1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            wanted[i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_query(spark, sf_dir):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op13_packing"](spark, sf_dir).collect()
    n = check_packed(rows, [(i, ids) for (i, _), ids in zip(docs, whole_ids([t for _, t in docs]), strict=True)], 4096)
    assert n == max(-(-sum(r.length for r in rows) // 4096), n - n // 500)


def test_packing_odd_rows_and_sequences(spark, odd_docs):
    p = packing.Params(capacity=16)
    df = odd_docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True)
    pieces = packing.pack(df.withColumn("number", F.lit("x")), queries.word_tokenizer(), params=p, keep_ids=True).cache()
    docs = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    n = check_packed(pieces.collect(), [(i, ids) for (i, _), ids in zip(docs, whole_ids([t for _, t in docs]), strict=True)], 16)
    whole = packing.sequences(pieces).collect()
    assert len(whole) == n and all(len(r.ids) == 4 * r.length for r in whole)
    place = {(r.sequence_id, r.offset): r.ids for r in pieces.collect()}
    assert all(bytes(r.ids) == b"".join(bytes(v) for (s, _), v in sorted(place.items()) if s == r.sequence_id) for r in whole)
    pieces.unpersist()


def test_knapsack():
    rng = np.random.default_rng(6)
    for _ in range(30):
        lengths, bounds = np.sort(rng.choice(np.arange(1, 30), 4, replace=False)), rng.integers(1, 4, 4)
        worth = rng.random(4)
        value, copies = packing.knapsack(lengths, worth, bounds, 40)
        ways = [c for c in itertools.product(*(range(b + 1) for b in bounds)) if np.dot(c, lengths) <= 40]
        assert abs(value - max(np.dot(c, worth) for c in ways)) < 1e-9 and abs(np.dot(copies, worth) - value) < 1e-9 and (copies <= bounds).all() and np.dot(copies, lengths) <= 40


def least_sequences(lengths, capacity):
    """By trying all ways, longest piece first."""
    best = [len(lengths)]
    lengths = sorted(lengths, reverse=True)

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[k]}:
            rest = list(rooms)
            rest.remove(room)
            put(k + 1, [*rest, room - lengths[k]])
        put(k + 1, [*rooms, capacity - lengths[k]])

    put(0, [])
    return best[0]


def test_plans_against_the_least_and_the_bound():
    rng = np.random.default_rng(8)
    p = packing.Params(capacity=30)
    over = 0
    for _ in range(60):
        lengths = rng.integers(3, 25, 9).tolist()
        plan = packing.plan_sequences(dict(Counter(lengths)), p)
        least = least_sequences(lengths, 30)
        assert plan.lower_bound <= least <= plan.sequences <= least + 1
        over += plan.sequences - least
    assert over <= 6
    # Ten thousand pieces of lengths that fill sequences only in threes: best fit alone opens far more.
    histogram = {15: 3000, 9: 3000, 6: 3000, 30: 7}
    plan = packing.plan_sequences(histogram, p)
    assert plan.sequences <= 3010 and plan.lower_bound == 3007 and plan.from_program >= 2700
    packing.Runs.of(plan, histogram, 30)


def test_the_program_beats_best_fit():
    """Best fit pairs the longest first and wastes what the program fills."""
    p = packing.Params(capacity=100)
    histogram = {40: 3000, 34: 3000, 33: 3000, 32: 3000, 26: 3000, 35: 3000}
    plan, plain = packing.plan_sequences(histogram, p), packing.Plan()
    packing._best_fit(plain, dict(histogram), 100)
    assert plan.sequences < plain.sequences and plan.sequences <= 1.005 * plan.lower_bound


def test_tokenizer_file_is_a_setting(tmp_path, monkeypatch):
    path = tmp_path / "t.json"
    path.write_bytes(json.dumps({"a": 1}).encode())
    monkeypatch.setenv("MILLRACE_WORD_TOKENIZER", str(path))
    assert queries.word_tokenizer() == path.read_bytes()


def test_rounds_of_components_run_few_stages(spark):
    """Each stage is planned by the driver, whose memory the pipeline once exceeded by its rounds."""
    from millrace.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (5, 5), (None, 7)], "a long, b long")
    spark.sparkContext.setJobGroup("components", "")
    found = {r.id: r.component for r in components(links).collect()}
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 103: 100, 101: 100}
    assert len(stages) < 90
