"""Operators that compare documents with each other or with the whole corpus."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tagflow.llm import backoff, components, decontaminate, jaccard, mixing, sentences, surrogates
from tagflow.llm.registered import load
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
ASCII_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long"


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def made(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or "ab")[i % len(sources or "ab")], len(t or ""), 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng, n=8):
    return " ".join(rng.choice(["alpha", "Beta", "gamma", "delta", "Été", "zeta", "eta", "theta", "iota"]) + str(rng.randint(0, 40)) for _ in range(n)) + "."


def some_texts(n=60, seed=5):
    rng = random.Random(seed)
    texts = [" ".join(sentence(rng) for _ in range(rng.randint(1, 9))) for _ in range(n)]
    for _ in range(n // 2):  # near copies
        w = rng.choice(texts).split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    return texts + texts[:5] + [None, None, "", " . ", "one", "one", "two words", "Éa b"]


@pytest.mark.parametrize("name", [k for k, (_, sql) in load().items() if sql])
def test_sql(spark, name):
    got = entry.queries()[name](spark, SF)
    cur = connect(SF).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert compare(got.columns, [tuple(r) for r in got.collect()], columns, cur.fetchall()) is None


def test_decontamination(spark):
    rng = random.Random(8)
    texts = some_texts(30)
    items = [(1, texts[0]), (1, texts[1]), (12, "one"), (3, "two words"), (None, texts[2]), (4, None), (5, "--"), (6, sentence(rng, 25)), (7, "absent item")]
    texts += [f"x {items[7][1]} y {texts[0]}", "TWO, words; two words two"]
    docs = made(spark, texts).union(made(spark, texts).limit(1))
    bench = spark.createDataFrame([(a, b, 0) for a, b in items], "item_id long, text string, n_hit int")
    windows = {}
    for item, text in items:
        w = ASCII_WORDS.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        w = ASCII_WORDS.findall(lower(text))
        hit, ids = set(), set()
        for win, who in windows.items():
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a : a + len(win)]) == win:
                    hit |= set(range(a, a + len(win)))
                    ids |= {str(x) for x in who if x is not None}
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) == (len(w), len(hit), sorted(ids), bool(hit))
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == {i for i in got if not got[i]["contaminated"]}
    assert not decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count()
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def brute_groups(texts, threshold=0.8):
    sets = []
    for t in texts:
        w = ASCII_WORDS.findall(lower(t))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = Counter(), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return links, [find(i) for i in range(len(texts))]


def test_jaccard_join(spark):
    texts = some_texts()
    docs = made(spark, texts)
    links, group = brute_groups(texts)
    got = {r["doc_id"]: r for r in jaccard.join(docs).collect()}
    assert [got[i]["n_links"] for i in range(len(texts))] == [links[i] for i in range(len(texts))]
    assert [got[i]["class_id"] for i in range(len(texts))] == group
    again = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None, None)], DOCS))
    kept = sorted((r["doc_id"] is None, r["doc_id"]) for r in jaccard.one_of_each(again).collect())
    assert kept == sorted({(False, g) for g in group} | {(True, None)}, key=lambda k: (k[0], k[1] or 0))
    assert jaccard.join(docs.limit(0)).count() == 0


def test_band_plan_reaches_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = jaccard.plan_bands(threshold, 0.99, 400)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99 and bands * rows <= 400


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_sentences_are_lossless_and_removed_by_span(spark):
    rng = random.Random(2)
    passage = " ".join(sentence(rng, 12) for _ in range(5))
    assert len(passage.split()) > 50
    texts = [f"{sentence(rng)}\n{passage}\n{sentence(rng)}" for _ in range(4)] + [sentence(rng, 90)] * 2
    texts += [None, "", " \n ", "a. b. c. a. b. c.", "no end", passage, passage, "x" * 50_000, "!? ..\t\n\n a"]
    docs = made(spark, texts)
    pieces = {r["doc_id"]: r["s"] for r in docs.select("doc_id", sentences.sentences(F.col("text")).alias("s")).collect()}
    clean = {i: [re.sub(r"\s+", " ", s).strip(" ").lower() for s in p] for i, p in pieces.items()}
    first, gone = {}, {i: set() for i in pieces}
    for i in sorted(clean):
        for a in range(len(clean[i]) - 2):
            run = tuple(clean[i][a : a + 3])
            if first.setdefault(run, (i, a)) != (i, a):
                gone[i] |= {a, a + 1, a + 2}
    for least in (1, 19):
        got = {r["doc_id"]: r for r in sentences.dedup(docs, least_words=least).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert "".join(pieces[i]) == (t or "")
            for k in sorted(gone[i]):  # short stretches stay
                if k - 1 not in gone[i]:
                    stretch = [k]
                    while stretch[-1] + 1 in gone[i]:
                        stretch.append(stretch[-1] + 1)
                    if len("".join(pieces[i][j] for j in stretch).split()) < least:
                        gone[i] -= set(stretch)
            want = None if t is None else "".join(s for k, s in enumerate(pieces[i]) if k not in gone[i])
            assert (got[i]["text"], got[i]["n_removed"]) == (want, len(gone[i]))
        assert (got[9]["n_removed"] > 0) == (least == 1)  # a. b. c. twice
    assert passage.split(".")[2] in got[0]["text"] and all(passage.split(".")[2] not in got[i]["text"] for i in (1, 2, 3))
    same = docs.where("doc_id = 0")
    assert all(r["n_removed"] == 0 for r in sentences.dedup(same.union(same)).collect())
    assert sentences.dedup(docs.limit(0)).count() == 0


def test_passages_within_sentences_are_found(spark):
    rng = random.Random(7)

    def words(n, stops=0.0):
        return [rng.choice(["the", "of", "und", "Été", "жук"]) + rng.choice(["", str(rng.randint(0, 99))]) + "." * (rng.random() < stops) for _ in range(n)]

    texts, passages = [], []
    for k in range(80):
        passages.append(words(50, (0, 0.04, 0.1, 0.3)[k % 4]))
        for _ in range(2):  # placed anywhere in a sentence, which runs on behind it
            texts.append(" ".join([*words(rng.randint(0, 30), 0.1), f"v{len(texts)}", *passages[-1], f"w{len(texts)}", *words(rng.randint(0, 30), 0.1)]))
    texts += ["Сегодня хороший день\u2026 今天天气很好。我们去公园！好吗？他们不来。", "另外今天天气很好。我们去公园！好吗？他们不来。"]
    rows = made(spark, texts)
    pieces = [r["s"] for r in rows.select(sentences.sentences(F.col("text")).alias("s"), "doc_id").orderBy("doc_id").collect()]
    assert ["".join(p) for p in pieces] == texts
    assert pieces[-2] == ["Сегодня хороший день\u2026 ", "今天天气很好。", "我们去公园！", "好吗？", "他们不来。"]
    got = {r["doc_id"]: r for r in sentences.dedup(rows).collect()}
    for k, p in enumerate(passages):
        assert got[2 * k]["n_removed"] == 0 and got[2 * k + 1]["n_removed"] >= 3, k
        left = got[2 * k + 1]["text"].split()
        assert f"v{2 * k + 1}" in left and f"w{2 * k + 1}" in left
    # The two share 14 characters only.
    assert got[len(texts) - 1]["text"] == texts[-1]
    got = {r["doc_id"]: r for r in sentences.dedup(rows, least_words=14).collect()}
    assert got[len(texts) - 1]["text"].startswith("另外") and "公园" not in got[len(texts) - 1]["text"]


def test_short_sentences_are_no_passage(spark):
    texts = ["First of all this. Yes. No. Ok. The one.", "Then another here. Yes. No. Ok. That two.", "今天。很好。好吗？", "今天。很好。好吗？"]
    got = sentences.dedup(made(spark, texts)).collect()
    assert all(r["n_removed"] == 0 and r["text"] == texts[r["doc_id"]] for r in got)


def test_backoff_against_counts(spark):
    texts = some_texts(20)
    docs = made(spark, texts)
    words = [lower(t).split() if t else [] for t in texts]
    tables = [Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)) for n in (1, 2, 3)]
    total = sum(tables[0].values())

    def value(context, word, least, own):
        if not context:
            return max(tables[0][word,] - own, 1) / (total - own), True
        whole = (*context, word)
        if tables[len(context)][whole] - own >= least:
            return (tables[len(context)][whole] - own) / (tables[len(context) - 1][tuple(context)] - own), True
        return 0.4 * value(context[1:], word, least, own)[0], False

    for order, least, own in ((2, 2, 0), (3, 2, 0), (3, 1, 1)):
        got = {r["doc_id"]: r for r in backoff.score(docs, order, least, own=own).collect()}
        for i, w in enumerate(words):
            want = [value(tuple(w[max(0, k - order + 1) : k]), x, least, own) for k, x in enumerate(w)]
            assert got[i]["n_words"] == len(w) and math.isclose(got[i]["log_score"], sum(math.log(v) for v, _ in want), rel_tol=1e-9, abs_tol=1e-9)
            assert got[i]["n_backed_off"] == sum(not seen for _, seen in want)
            assert (got[i]["mean_log_score"] is None) == (not w)
    assert backoff.score(docs.limit(0)).count() == 0


def test_backoff_reads_nothing_ahead_and_has_one_table(spark):
    docs = made(spark, ["a", "a b", "b a b", "a b", None, " "])
    spark.sparkContext.setJobGroup("backoff plans", "")
    try:
        got = backoff.score(docs)
        known = backoff.table(docs, 3, 1, 0.4, 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # No pass over the texts for the number of words: it comes from the counts of single words.
    assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("backoff plans"))
    # Every place is in the longest table, also where a text begins: a, a b, b, b a, b a b.
    assert known.count() == known.select("h").distinct().count() == 5
    a, ab = math.log(3 / 7), math.log(2 / 3)
    want = {0: (1, 0, a), 1: (2, 0, a + ab), 2: (3, 2, a + math.log(0.4 * 3 / 7) + math.log(0.4) + ab), 3: (2, 0, a + ab), 4: (0, 0, 0.0), 5: (0, 0, 0.0)}
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows.keys() == want.keys()
    for i, (n, off, score) in want.items():
        assert (rows[i]["n_words"], rows[i]["n_backed_off"]) == (n, off) and math.isclose(rows[i]["log_score"], score, abs_tol=1e-9)


def test_backoff_of_repeated_and_long_rows(spark):
    docs = made(spark, ["a b a c"] * 2 + [None, "word " * 60_000]).where("doc_id > 0")
    same = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = docs.select("doc_id", "text").union(same).withColumn("value", F.lit(1)).withColumn("h", F.lit("x"))
    got = backoff.score(rows)
    equal = got.where("doc_id is null").groupBy("n_words", "n_backed_off", F.round("log_score", 6).alias("s")).count().collect()
    # a, b after a, c after a b; the other text adds one b after a and two words a.
    total = 4 + 60_000 + 30_000 - 1
    want = math.log(10_001 / total) + math.log(10_000 / 10_001) + math.log(9_999 / 10_000)
    assert [tuple(r) for r in equal] == [(3, 0, round(want, 6), 10_000)]
    one = {r["doc_id"]: r for r in got.where("doc_id is not null").collect()}
    assert (one[2]["n_words"], one[2]["log_score"], one[2]["mean_log_score"]) == (0, 0.0, None)
    assert one[3]["n_words"] == 60_000 and one[3]["n_backed_off"] == 0 and one[1]["n_backed_off"] == 2


def test_surrogates(spark):
    texts = [
        "Mr. John Smith and Mrs. Anna Bell; Mr John Smith wrote to A.b-1@Foo.com, a.b-1@foo.com of 10.0.0.1.",
        "card 4111 1111 1111 1111 and 4111111111111111, tel +1 (988) 555-2485 / +1 (988) 555-2486; 10.0.0.1",
        "госпожа Иванова, господин Петров. Frau Müller", None, "", "nothing here", "id 12 and 3.5", "tel +1 (988) 555-2485",
    ] + [f"x u{i}@a.org 10.1.{i}.7 q" for i in range(150)] + ["a@b.co c@d.co e@f.co " + " ".join(f"{c}@z.co" for c in "ghijklmnopqrstuv")]
    docs = made(spark, texts)
    rows = {r["doc_id"]: r for r in surrogates.replace(docs).collect()}
    assert rows[3]["text"] is None and rows[5]["text"] == texts[5] and rows[6]["text"] == texts[6]
    a = rows[0]["text"]
    male = re.findall(r"Mr\.? (\w+ \w+)", a)
    assert len(male) == 2 and male[0] == male[1] and "Smith" not in a and "Bell" not in a and "Foo" not in a
    assert male[0].split()[0] in surrogates.GIVEN["m", "latin"]
    assert re.search(r"Mrs\. (\w+)", a)[1] in surrogates.GIVEN["f", "latin"]
    mails = re.findall(r"\S+@[\w.]+\w", a)
    assert len(mails) == 2 and mails[0] == mails[1]
    b = rows[1]["text"]
    spaced = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})", b)
    assert spaced and spaced[1].replace(" ", "") == spaced[2] != "4" + "1" * 15
    digits = [int(c) for c in spaced[2]][::-1]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", b)
    assert len(set(phones)) == 2 and phones[0] in rows[7]["text"]
    assert re.search(r"10\.0\.0\.1", b) is None and re.search(r"\d+\.\d+\.\d+\.\d+", a)[0] == re.search(r"\d+\.\d+\.\d+\.\d+", b)[0]
    assert re.fullmatch(r"госпожа [А-Яа-яё]+, господин [А-Яа-яё]+\. Frau [A-Z][a-z]+", rows[2]["text"])
    many = [re.findall(r"\S+@\S+", rows[8 + i]["text"])[0] for i in range(150)]
    assert len(set(many)) == 150 and not set(many) & {f"u{i}@a.org" for i in range(150)}
    last = re.findall(r"\S+@\S+", rows[len(texts) - 1]["text"])
    assert len(last) == len(set(last)) == 19
    assert {r["doc_id"]: r["text"] for r in surrogates.replace(docs).collect()} == {i: r["text"] for i, r in rows.items()}
    assert surrogates.replace(docs.limit(0)).count() == 0


def test_phones_and_later_mentions(spark):
    phones = ["06 12 34 56 78", "+33 6 12 34 56 78", "+33612345678", "5551234567", "+15551234567", "030/1234567", "91 123 45 67", "+1 (988) 555-2485", "555-123-4567"]
    clean = ["value 12.345 here", "in 1999-2004 and", "on 2024-01-15, 3.14159 or 12.05.2024"]
    names = ["Mr John Smith came. Later John Smith spoke, Smith's hat; Mr. Smith and John left. Smithson stayed.", "Smith and John are not known here."]
    texts = [f"call {p} now" for p in phones] + clean + names
    got = {r["doc_id"]: r for r in surrogates.replace(made(spark, texts)).collect()}
    for i, p in enumerate(phones):
        t = got[i]["text"]
        assert re.fullmatch("call " + re.sub("[0-9]", "[0-9]", re.escape(p)).replace("/", "/") + " now", t) and p not in t and got[i]["n_phone"] == 1, t
    for i, t in enumerate(clean):
        assert got[len(phones) + i]["text"] == t
    a = got[len(texts) - 2]["text"]
    m = re.fullmatch(r"Mr (\w+) (\w+) came\. Later (\w+) (\w+) spoke, (\w+)'s hat; Mr\. (\w+) and (\w+) left\. Smithson stayed\.", a)
    assert m and m[1] == m[3] == m[7] != "John" and m[2] == m[4] == m[5] == m[6] != "Smith", a
    assert got[len(texts) - 1]["text"] == names[1]


def test_surrogates_do_not_run_out(spark):
    made_up = ["Mr " + "".join(chr(97 + i // 26**k % 26) for k in range(4)).capitalize() for i in range(200)]
    rows = [("phone", str(10_000 + i)) for i in range(88_000)] + [("name", n) for n in made_up]
    rows += [("name", f"господин Я{i:05d}".translate({48 + d: "абвгдежзик"[d] for d in range(10)})) for i in range(11_000)] + [("ip", "1.2.3.4"), ("card", "4111111111111111")]
    found = surrogates.assign(spark.createDataFrame(rows, "kind string, entity string")).collect()
    assert {(r["kind"], r["entity"]) for r in found} == set(rows) and len(found) == len(rows)
    new = [(r["kind"], r["surrogate"]) for r in found]
    assert len(set(new)) == len(new) and not set(new) & set(rows)
    longer = next(r["surrogate"] for r in found if r["kind"] == "phone" and len(r["surrogate"]) > 5)
    shown = spark.range(1).select(surrogates._like(F.lit("12 345"), F.lit("phone"), F.lit(longer)).alias("t")).first()["t"]
    assert shown.replace(" ", "") == longer


def test_targets_are_filled_as_by_resharing(spark):
    sizes = {"a": 10, "b": 400, "c": 7, "d": 0, None: 90, "z": 50}
    units = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(units).collect()}
    names = ["a", "b", "c", "d", "z", None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
            free.remove(s)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in names)


def test_mixing(spark):
    rng = random.Random(6)
    texts = [" ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 3, 10, 60]))) for _ in range(500)] + [None, ""]
    docs = made(spark, texts, ["a", "b", "c", None])
    docs = docs.union(docs.limit(4))
    rows = mixing.mix(docs, block=7).collect()
    assert len(rows) == len(texts) + 4
    taken, target = Counter(), {}
    for r in rows:
        want = len(SPACED.findall(texts[r["doc_id"]] or ""))
        assert r["size"] == want and 0 <= r["taken"] <= 2 * want and r["taken"] == r["copies"] * want
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        c = r["target"] / r["source_size"]
        assert r["copies"] in (math.floor(c + 1e-9), math.ceil(c - 1e-9))
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    key = lambda x: sorted(map(str, x))
    assert key(rows) == key(mixing.mix(docs.repartition(5), block=7).collect())
    mixed = mixing.mixed(docs).collect()
    assert {"copies", *docs.columns} == set(mixed[0].asDict()) and all(r["copies"] > 0 for r in mixed)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rounding_keeps_expectations(spark):
    docs = made(spark, ["a b c"] * 30 + ["d"] * 30, ["s"])
    hits = Counter()
    for seed in range(12):
        for r in mixing.mix(docs, share=1.4, seed=seed, block=16).collect():
            hits[r["doc_id"]] += r["copies"]
    assert 1.2 < sum(hits.values()) / 720 < 1.6 and len({hits[i] for i in range(60)}) > 1


def test_pipeline(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(900_001, None, None, None, None), (900_002, "", "en", "src0", 0), (None, "the of and in thing to that", None, None, 27)]
    extra = spark.createDataFrame(odd, source.schema)
    docs = source.union(extra).union(source.limit(2))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == source.columns
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append({r["doc_id"]: r["text"] for r in now.select("doc_id", "text").collect()})
    first, second, third, fourth, fifth = seen
    assert 900_001 not in first and 900_002 not in first and len(first) >= 0.9 * source.count()
    ids = sorted(first, key=lambda x: (x is not None, x))
    _, group = brute_groups([first[i] for i in ids])
    assert set(second) == {ids[g] for g in set(group)}
    assert now.count() == len(fifth)  # repeated rows became one
    items = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = ASCII_WORDS.findall(lower(r["text"]))
        items |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    dirty = set()
    for i, t in second.items():
        w = ASCII_WORDS.findall(lower(t))
        if any(tuple(w[k : k + 10]) in items for k in range(len(w) - 9)):
            dirty.add(i)
    assert set(third) == set(second) - dirty
    assert set(fourth) == set(third) and not any("AKIA" in t for t in fourth.values())
    assert set(fifth) <= set(fourth) and all(fifth[i] == fourth[i] for i in fifth)
    empty = source.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
