"""Whole operators that SQL cannot express, against plain Python."""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id, mixing, pii, queries, topics
from tests.llm.test_scans import python_feistel

MASK = 2**64 - 1


def grams(text, p):
    """The buckets of the n-grams of a text, one by one."""
    s = " "
    for c in text:
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        s += "" if c == " " and s[-1] == " " else c
    for n in p.orders:
        for i in range(len(s) - n + 1):
            h = n
            for c in s[i : i + n]:
                h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 & MASK
                h ^= h >> 29
            yield (h * 0xBF58476D1CE4E5B9 & MASK) >> (64 - p.buckets.bit_length() + 1)


def brute_bayes(rows, p):
    counts, docs = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        if text is not None and lang is not None:
            docs[lang] += 1
            counts[lang].update(grams(text, p))

    def predict(text):
        if text is None or not any(map(str.isalpha, text)) or not docs:
            return "und", 0.0
        found = list(grams(text, p))
        logs = {}
        for lang in sorted(docs):
            whole = sum(counts[lang].values()) + p.smoothing * p.buckets
            logs[lang] = math.log(docs[lang] / docs.total()) + sum(math.log((counts[lang][b] + p.smoothing) / whole) for b in found)
        best = max(logs, key=logs.get)
        temper = max(len(found) / p.scale, 1.0)
        return best, 1 / sum(math.exp((x - logs[best]) / temper) for x in logs.values())

    return {i: predict(t) for i, t, _ in rows}


@pytest.mark.parametrize("block", [256, 2])
def test_naive_bayes_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    parts = {"xx": "ab ca bad ", "yy": "éçö üa b ", "zz": "ka lo mi ", "ww": "ab ka éç ", "vv": "zo "}
    rows = []
    for i in range(60):
        lang = list(parts)[min(int(rng.integers(9)), 4)]
        rows.append((i, "".join(rng.choice(list(parts[lang] + " 1."), int(rng.integers(1, 60)))), lang))
    rows += [(60, None, "xx"), (61, "abc", None), (62, "", "yy"), (63, "½ ² ① 12", "zz"), (64, "ЖУК K ŉ", "zz"), (65, "ab ca " * 300 + "é", "xx"), (66, "\U0001d4b3\U0001f600 a", None)]
    p = language_id.Params(buckets=256, block=block)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chunk, language_id._CHUNK = language_id._CHUNK, 1000
    try:
        model = language_id.fit(df, F.lit(True), params=p)
        direct = {i: language_id.score_text(t, model) for i, t, _ in rows}
    finally:
        language_id._CHUNK = chunk
    assert len(model.blocks) == (1 if block == 256 else 3) and model.langs == sorted(parts)
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(df, model).collect()}
    for i, (lang, score) in brute_bayes(rows, p).items():
        for got in (out[i], direct[i]):
            assert got[0] == lang and abs(got[1] - score) < 1e-4, (i, got, lang, score)


def brute_rake(cells, targets, sweeps):
    weight = {c: float(n) for c, n in cells.items()}
    for _ in range(sweeps):
        for at, to in enumerate(targets):
            sums = Counter()
            for c, w in weight.items():
                sums[c[at]] += w
            weight = {c: w * to[c[at]] / sums[c[at]] if c[at] in to else w for c, w in weight.items()}
    return weight


def test_mixing_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(0, 40)), ["en", "de", None][int(rng.integers(3))], f"s{int(rng.integers(4))}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    topic = F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b")
    out = {r.doc_id: r for r in mixing.mix(docs, topic=topic).collect()}
    cells = Counter()
    for i, t, lang, source in rows:
        cells[source, lang or "(none)", "b" if i % 3 else "a"] += max(1, len(t.split()))
    targets = []
    for at, power in ((0, 0.7), (1, 0.7), (2, 1.0)):
        sums = Counter()
        for c, n in cells.items():
            sums[c[at]] += n
        whole = sum(n**power for n in sums.values())
        targets.append({v: n**power / whole for v, n in sums.items()})
    weight = brute_rake(cells, targets, 400)
    top = max(w / cells[c] for c, w in weight.items())
    for i, t, lang, source in rows:
        cell = source, lang or "(none)", "b" if i % 3 else "a"
        draw = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:12], 16) / 16**12
        prob = weight[cell] / cells[cell] / top
        assert abs(out[i].prob - prob) < 1e-6 and abs(out[i].draw - draw) < 1e-12 and out[i].drawn == (out[i].draw < out[i].prob) and out[i].margin_error <= mixing.TOLERANCE


def test_targets_that_cannot_be_met_are_told(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "y", "t", 30)], "source string, lang string, topic string, tokens long")
    to = lambda **k: spark.createDataFrame(list(k.items()), "value string, target double")
    for n in (100, 0):
        rows = mixing.rake(cells, {"source": to(a=0.5, b=0.5), "lang": to(x=0.1, y=0.9)}, 3, local_cells=n).collect()
        assert len(rows) == 2 and all(abs(r.margin_error - 0.8) < 1e-9 for r in rows)  # after the languages, source a has 0.1 and b 0.9 in place of 0.5


def test_topics_equal_brute_force_and_ignore_row_order(spark):
    rng = np.random.default_rng(6)
    words = {k: [f"{k}{j}" for j in range(30)] for k in "abc"}
    rows = [(i, " ".join(rng.choice(words["abc"[i % 3]], 40)), "en" if i % 2 else "de") for i in range(240)] + [(500, None, "en"), (501, " \n", None), (502, "a1 a2 a3", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = topics.Params(topics=3, buckets=128, max_rows=100)
    model, other = topics.fit(df, params=p), topics.fit(df.repartition(7), params=p)
    assert (model.centers == other.centers).all() and len(model.centers) == 3
    out = {r.doc_id: (r.topic, r.n_tokens) for r in topics.assign(df.withColumn("topic", F.lit("clash")), model).collect()}
    for i, text, lang in rows:
        counts = topics.word_counts((text or "").encode(), p)
        x = np.log1p(counts) * model.rarity
        x = x / max(np.linalg.norm(x), 1e-12) - model.means.get(lang, model.means[None])
        want = "empty" if not counts.sum() else f"t{int(np.argmin(((x - model.centers) ** 2).sum(axis=1)))}"
        assert out[i] == (want, len((text or "").split()))
    kinds = {k: {out[i][0] for i in range(240) if i % 3 == k} for k in range(3)}
    assert all(len(v) == 1 for v in kinds.values()) and len(set.union(*kinds.values())) == 3
    assert topics.fit(df.filter("doc_id = 500")).centers.shape[0] == 1


def test_topics_are_fitted_on_all_texts(spark):
    """Also on words, languages and texts beyond the sample of the first centres."""
    rng = np.random.default_rng(8)
    words = {k: [f"{k}{j}" for j in range(20)] for k in "ab"}
    rows = [(i, " ".join(rng.choice(words["ab"[i % 2]], 25)), ["en", "de", None][i % 3]) for i in range(200)] + [(900, "late words only here", "fi")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = topics.Params(topics=2, buckets=64, max_rows=5)
    model = topics.fit(df, params=p)
    counts = np.stack([topics.word_counts(text.encode(), p) for _, text, _ in rows])
    assert np.allclose(model.rarity, np.log(203 / (1 + (counts > 0).sum(axis=0))) + 1)
    x = np.log1p(counts) * model.rarity
    x = np.rint(x / np.linalg.norm(x, axis=1, keepdims=True) * topics.SCALE)
    said = [lang for *_, lang in rows]
    assert set(model.means) == {"en", "de", "fi", None}
    for lang in model.means:
        assert (model.means[lang] * topics.SCALE == np.rint(x[[lang in (None, v) for v in said]].mean(axis=0))).all()
    x = x / topics.SCALE - np.stack([model.means[v] for v in said])
    at = ((x[:, None] - model.centers) ** 2).sum(axis=2).argmin(axis=1)
    for k in range(2):  # no centre moves any more
        assert (np.rint(x[at == k].mean(axis=0) * topics.SCALE) == model.centers[k] * topics.SCALE).all()
    two = topics.fit(df.filter("doc_id < 900").repartition(5), params=topics.Params(topics=2, buckets=64, max_rows=5, languages=1))
    assert set(two.means) == {"de" if said.count("de") > said.count("en") else "en" if said.count("en") > said.count("de") else "de", None}


def test_texts_are_hashed_once_for_topics(spark):
    """By an operator that returns no texts; twice where they are returned. Rounds and topics are made from what was counted."""
    rows = [(i, f"s{i % 3}", "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string").repartition(2)
    for keep_text, times in ((False, 1), (True, 2)):
        read = spark.sparkContext.accumulator(0)

        def text(i, read=read):
            read.add(1)
            return " ".join(f"{'ab'[i % 2]}{(i * j) % 11}" for j in range(1, 20))

        out = mixing.mix(docs.withColumn("text", F.udf(text, "string").asNondeterministic()("doc_id")), keep_text=keep_text, share=0.5).collect()
        assert len(out) == len(rows) and all(r.n_tokens == 19 and r.topic != "empty" and r.prob is not None for r in out)
        assert read.value == times * len(rows)


def test_topics_from_counts_equal_brute_force(spark):
    """Also with components above 255, several pages of buckets, texts longer than are hashed together, and no words."""
    rng = np.random.default_rng(9)
    words = {k: [f"{k}{j}" for j in range(150)] for k in "abc"}
    rows = [(i, " ".join(rng.choice(words["abc"[i % 3]], int(rng.integers(1, 60)))), ["en", "de", None][int(rng.integers(3))]) for i in range(300)]
    rows += [(400, None, "en"), (401, "", None), (402, " \n", "de"), (403, "a1", "fr"), (404, "b7 B7 " * 9000 + "c1" * 20_000, "en"), (405, "x" * 300_000 + " a1", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = topics.Params(topics=3, buckets=600, max_rows=50)
    counts = np.stack([topics.word_counts((text or "").encode(), p) for _, text, _ in rows])
    counted = topics.count(df, ["doc_id", "lang"], params=p)
    model = topics.fit_counts(counted)
    x = np.log1p(counts) * model.rarity
    x = np.rint(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) * topics.SCALE)
    assert x.max() > 255
    some = counts.any(axis=1)
    for lang in model.means:
        assert (model.means[lang] * topics.SCALE == np.rint(x[some & [lang in (None, v) for _, _, v in rows]].mean(axis=0))).all()
    x -= np.stack([model.means[v] for _, _, v in rows]) * topics.SCALE
    centers = model.centers * topics.SCALE
    at = (x @ centers.T - (centers * centers).sum(axis=1) / 2).argmax(axis=1)
    for k in range(len(centers)):  # no centre moves any more
        assert (np.rint(x[some & (at == k)].mean(axis=0)) == centers[k]).all()
    want = {i: (f"t{k}" if n else "empty", n) for (i, *_), k, n in zip(rows, at, counts.sum(axis=1).tolist(), strict=True)}
    for out in (topics.assign_counts(counted, model), topics.assign(df, model), topics.assign(df.repartition(9), model, keep_text=False)):
        assert {r.doc_id: (r.topic, r.n_tokens) for r in out.collect()} == want


def sha(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def brute_pair(high, low, high_size, low_size, key, kind):
    for i in range(1, pii.ROUNDS + 1):
        high = (high + int(sha(key, kind, 0, i, low)[:8], 16)) % high_size
        low = (low + int(sha(key, kind, 0, i, high)[:8], 16)) % low_size
    return high, low


FORMS = ((r"\d{4}-", "%Y-%m-%d"), (r"\d{4}/", "%Y/%m/%d"), (r"(1[3-9]|2\d|3[01])/", "%d/%m/%Y"), (r"\d\d/", "%m/%d/%Y"), (r"\d\d\.", "%d.%m.%Y"))
DAY_0 = datetime.date(1800, 1, 1).toordinal()


def day_of(m):
    form = next(f for p, f in FORMS if re.match(p, m))
    try:
        return datetime.datetime.strptime(m, form).date().toordinal() - DAY_0, form
    except ValueError:
        return None, form


def mod_97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))) % 10


def refill(shape, letters, keep):
    letters = iter(letters)
    return "".join(next(letters) if re.match(f"[{keep}]", c) else c for c in shape)


def written_day(day, form):
    d = datetime.date.fromordinal(day + DAY_0)
    return form.replace("%Y", f"{d.year:04}").replace("%m", f"{d.month:02}").replace("%d", f"{d.day:02}")


DIALLED = [f"{a}{b}" for a in range(200, 1000) for b in range(200, 1000)]
OTHERS = [f"{a:03}{b:03}" for a in range(200) for b in range(1000)] + [f"{a}{b:03}" for a in range(200, 1000) for b in range(200)]
PLACES = {name: {x: i for i, x in enumerate(listed)} for name, listed in (("dialled", DIALLED), ("ten", OTHERS))}


def brute_ten(digits, key):
    if len(digits) != 10:
        return python_feistel(digits, pii.DIGITS, key, "phone")
    name, listed = ("dialled", DIALLED) if digits[0] > "1" and digits[3] > "1" else ("ten", OTHERS)
    high, low = brute_pair(PLACES[name][digits[:6]], int(digits[6:]), len(listed), 10_000, key, name)
    return f"{listed[high]}{low:04}"


def brute_pseudonym(m, key):
    digits = re.sub("[^0-9]", "", m)
    full = lambda p: re.fullmatch(p, m)
    if "@" in m:
        local, domain = m.split("@")
        if not re.search("[A-Za-z0-9]", local):
            return None, m
        local = local.lower()
        return "email", refill(local, python_feistel(re.sub("[^a-z0-9]", "", local), pii.ALNUM, key, "email"), "a-z0-9") + "@" + domain
    if full(pii.DATE):
        day, form = day_of(m)
        if day is None or not -4 * pii.CYCLE <= day < 20 * pii.CYCLE:
            return None, m
        high, low = brute_pair(day % pii.CYCLE // 189, day % pii.CYCLE % 189, 773, 189, key, "date")
        return "date", written_day(high * 189 + low + day // pii.CYCLE * pii.CYCLE, form)
    if full(f"{pii.PHONE}|{pii.PLAIN}") or m[0] == "+":
        if not full(f"{pii.PHONE}|{pii.PLAIN}") and len(digits) < 8:
            return None, m
        country = re.match(rf"\+({pii.COUNTRY})", m)[1] if m[0] == "+" else ""
        return "phone", refill(m, country + brute_ten(digits[len(country) :], key), "0-9")
    if full(pii.SSN):
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None, m
        areas = [a for a in range(1, 900) if a != 666]
        high, low = brute_pair(areas.index(area) * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
        return "ssn", refill(m, f"{areas[high // 99]:03}{high % 99 + 1:02}{low + 1:04}", "0-9")
    if full(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"):
        octets = [int(x) for x in m.split(".")]
        if max(octets) > 255:
            return None, m
        packed = python_feistel("".join(f"{o:02x}" for o in octets), pii.HEX, key, "ip")
        return "ip", ".".join(str(int(packed[i : i + 2], 16)) for i in range(0, 8, 2))
    if m[0].isalpha():
        compact = m.replace(" ", "")
        if len(compact) < 15 or mod_97(compact[4:] + compact[:4]) != 1:
            return None, m
        bban = refill(compact[4:], python_feistel(re.sub("[^0-9]", "", compact[4:]), pii.DIGITS, key, "iban"), "0-9")
        bban = refill(bban, python_feistel(re.sub("[^A-Z]", "", bban), pii.LETTERS, key, "iban"), "A-Z")
        return "iban", refill(m, f"{compact[:2]}{98 - mod_97(bban + compact[:2] + '00'):02}{bban}", "A-Z0-9")
    if luhn(digits):
        return None, m
    payload = python_feistel(digits[:-1], pii.DIGITS, key, "card")
    return "card", refill(m, payload + str(-luhn(payload + "0") % 10), "0-9")


def brute_pii(text, key):
    n, out, at = Counter(), [], 0
    for m in re.finditer(pii.PATTERN, text or "", re.ASCII):
        kind, new = brute_pseudonym(m[0], key)
        n[kind] += 1
        out += [text[at : m.start()], new]
        at = m.end()
    return None if text is None else "".join(out) + text[at:], tuple(n[k] for k in pii.KINDS)


SAMPLES = [
    "DE89370400440532013000 and DE89 3704 0044 0532 0130 00 AND GB82 WEST 1234 5698 7654 32 not GB82WEST12345698765433, NL91ABNA0417164300.", "123-45-6789 667-01-0001 899-99-9999 665-99-9999 001-01-0001 666-01-0001 900-01-0001 123-00-4567",
    "0200-01-01 9799-12-31 0199-12-31 9800-01-01 1799-12-31 2200-01-01 2024-02-29T10:00:00Z 31/12/1999 12/31/1999 31.12.1999 1999/12/31 30/02/2020", "+44 20 7946 0958 (632) 555-4827 6325554827 +1 632 555 4827",
    "a@b.example ._@b.example X.Y-1@b.co.example 255.255.255.255 256.1.1.1 1.2.3.4.5 4337 1665 9846 4399 3782 822463 10005 4337166598464398",
]


def test_pii_equals_brute_force_and_stays_valid(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(-1 - i, s) for i, s in enumerate([*SAMPLES, None, "", "é 12 😀"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_ssn", F.lit("clash"))
    once = pii.pseudonymise(df, key="secret").cache()
    out = {r.doc_id: r for r in once.collect()}
    counts = lambda r: tuple(r[f"n_{k}"] for k in pii.KINDS)
    for i, text in rows:
        assert (out[i].text, counts(out[i])) == brute_pii(text, "secret"), i
    again = {r.doc_id: counts(r) for r in pii.pseudonymise(once, key="other").collect()}
    assert again == {i: counts(r) for i, r in out.items()} and min(map(sum, zip(*again.values(), strict=True))) > 0
    once.unpersist()
    with pytest.raises(ValueError):
        pii.pseudonymise(df, key="")


def test_plain_phones_stay_phones(spark):
    """20,000 of 20,000; a number keeps its link with its other forms, and no two become one."""
    n = F.col("id") * 7_919
    digits = F.concat((n % 800 + 200).cast("string"), (n * 31 % 800 + 200).cast("string"), F.lpad((n % 10_000).cast("string"), 4, "0"))
    forms = F.concat(F.lit("ring "), digits, F.lit(" or ("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 3), F.lit("-"), F.substring(digits, 7, 4), F.lit(" or +1 "), digits)
    out = pii.pseudonymise(spark.range(20_000).select(digits.alias("was"), forms.alias("text")), key="k")
    new = {}
    for r in out.collect():
        a, b, c = (re.sub("[^0-9]", "", part)[-10:] for part in r.text.split(" or "))
        assert re.fullmatch(pii.PLAIN, a) and a == b == c and r.n_phone == 3
        assert new.setdefault(r.was, a) == a
    assert len(set(new.values())) == len(new) and sum(a == b for a, b in new.items()) < 5
    odd = spark.range(5_000).select(F.lpad((F.col("id") * 393_333_331 % 10**10).cast("string"), 10, "0").alias("was")).distinct()
    assert odd.select(pii.feistel_ten(F.col("was"), "k").alias("v")).distinct().count() == odd.count()


def test_ssn_permutes_the_valid_numbers(spark):
    digits = F.concat(F.lpad((F.col("id") % 898 + 1 + (F.col("id") % 898 >= 665).cast("int")).cast("string"), 3, "0"), F.lit("07"), F.lpad((F.col("id") % 9999 + 1).cast("string"), 4, "0"))
    out = spark.range(20_000).select(pii.feistel_ssn(digits, "k").alias("v"))
    assert out.filter(pii.kind_of(F.regexp_replace("v", "^(...)(..)", "$1-$2-")).isNull()).count() == 0
    assert out.distinct().count() == spark.range(20_000).select(digits).distinct().count()


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory, spark):
    d = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0), (6, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_over_odd_rows(spark, odd_dir, odd_docs, no_docs):
    """Nulls, empty and long texts, ties, repeated rows, clashing names, empty tables."""
    import corpus_pipeline as cp

    clash = ["node", "score", "predicted", "topic", "n_tokens", "drawn", "prob", "_id", "_line_id", "kept_text", "n_lines", "ids", "kept", "component_id", "_text"]
    docs = odd_docs.select("*", *[F.lit("clash").alias(c) for c in clash])
    some = {"quality": None, "line_dedup": 9, "near_duplicates": 6, "mix_sources": None, "encode": 9}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, odd_dir)
        assert set(out.columns) == (set(cp.COLUMNS) if name != "encode" else {"doc_id", "lang", "source", "n_chars", "ids", "n_pieces", "n_bytes", "lossless"})
        n = out.count()
        assert n == some[name] if some[name] else 0 <= n <= 9
        assert stage(spark, no_docs, odd_dir).count() == 0


def test_stages_one_by_one(spark, odd_dir):
    import corpus_pipeline as cp

    rows = [(None, "one two three four five six", "en", "s", 1), (7, "one two three four five six", "en", "s", 1), (8, "one two three four five six", "en", "s", 1), (9, None, "en", "s", 0), (None, "x", None, None, None), (None, "y", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = sorted(str((r.doc_id, r.text)) for r in cp.near_duplicates(spark, docs, odd_dir).collect())
    assert near == sorted(str(r[:2]) for i, r in enumerate(rows) if i not in (1, 2))
    line = "a line of more than forty characters, many times"
    lines = spark.createDataFrame([(i if i else None, f"{line}\nown {i}", "en", "s", 1) for i in range(6)], docs.schema)
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.line_dedup(spark, lines, odd_dir).collect()}
    assert got == {i or None: (f"{line}\nown 5", len(line) + 6) if i == 5 else (f"own {i}", 5) for i in range(6)}
    mixed = cp.mix_sources(spark, docs.union(docs), odd_dir).groupBy("doc_id", "text").count().collect()
    assert all(r["count"] % 2 == 0 for r in mixed)
    assert {tuple(r.ids) for r in cp.encode(spark, docs.filter("doc_id IN (7, 8)"), odd_dir).collect()} == {tuple(queries.pieces.encode_batch([rows[1][1]], queries.pieces.load(queries.piece_model()))[0])}
