"""Operators on single texts, against brute force, exact round trips or held-out accuracy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from mainspool.llm import decision_list, html_text, language, licenses, ordinal, sentencepieces
from mainspool.llm.queries import PIECES

ODD = [None, "", " ", "  two  spaces ", "line\n\nends\r\n\ttabs", "naïve ß 漢字 🜚 é", "a" * 300, "x▁y", "<s> <0x41> </s>", "Mixed, marks!! and ### signs|here"]


@pytest.fixture(scope="module")
def model():
    return sentencepieces.load(PIECES)


@pytest.fixture(scope="module")
def unigram(model):
    """The public library, told to take the same pieces as a unigram model."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_ids_like_the_library_lattice(model, unigram):
    """The best path of the library's lattice, where one path alone is best."""
    pieces = sentencepieces.Pieces(model)
    rng = random.Random(9)
    texts = [t[:40] for t in ODD if t] + ["".join(rng.choice("theraions du") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    total = lambda ids: sum(unigram.get_score(i) for i in ids)
    alone = 0
    for text in texts:
        best, *rest = unigram.nbest_encode(text, nbest_size=2)
        if not rest or total(best) - total(rest[0]) > 0.5:
            alone += 1
            assert pieces.encode(text) == best, text
        else:
            assert total(pieces.encode(text)) >= total(best) - 0.5
    assert alone > 300


def test_scores_of_documents_reach_the_library(spark, model, unigram):
    pieces = sentencepieces.Pieces(model)
    total = lambda ids: sum(unigram.get_score(i) for i in ids if i > 258)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert total(pieces.encode(r.text)) >= total(unigram.encode(r.text)) - 1


def test_no_path_scores_higher(model):
    pieces = sentencepieces.Pieces(model)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(259, sp.get_piece_size())}
    rng = random.Random(1)
    for _ in range(200):
        word = "▁" + "".join(rng.choice("theraionsßé.#") for _ in range(rng.randint(1, 10)))
        best = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                if word[start:end] in score:
                    best[end] = max(best[end], best[start] + score[word[start:end]])
        assert sum(sp.get_score(i) for i in pieces.best(word)) == pytest.approx(best[-1])


def test_round_trip_of_whole_texts(spark, model):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, "long word " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' as ids", "1 as n_tokens")
    encoded = sentencepieces.encode(df, model)
    got = {r.doc_id: r for r in sentencepieces.decode(encoded, model).collect()}
    for i, text in rows:
        assert got[i].decoded == (None if text is None else text.replace("▁", " "))
        assert got[i].round_trip is (None if text is None else True)
        assert got[i].n_tokens == (None if text is None else len(got[i].ids))
    assert sentencepieces.encode(df.limit(0), model).count() == 0


def test_a_full_memo_changes_nothing(model, monkeypatch):
    free, full = sentencepieces.Pieces(model), sentencepieces.Pieces(model)
    monkeypatch.setattr(sentencepieces, "MEMO", 0)
    assert full.encode("the same words the same words") and not full.memo
    monkeypatch.undo()
    assert free.encode("the same words the same words") == full.encode("the same words the same words")


# language


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(2)
    sounds = {"aa": "bcdlou", "bb": "nprst aei", "cc": "xyzwqk uo"}
    rows = []
    for i in range(600):
        lang = rng.choice(list(sounds))
        text = "".join(rng.choice(sounds[lang]) for _ in range(rng.randint(3, 200)))
        rows.append((i, text, lang if i % 10 else rng.choice(list(sounds)), f"host{i % 7}", lang))
    rows += [(600, None, "aa", "host1", None), (601, "", None, None, None), (602, "漢字仮名交じり文" * 30, None, "host2", "und"), (603, "123 456", "bb", "host3", None), (604, "bcdlou" * 30_000, None, None, "aa")]
    return rows, spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")


def test_languages_are_found(tongues):
    rows, df = tongues
    got = {r.doc_id: r for r in language.identify(df.selectExpr("*", "1 as posterior", "0 as kept")).collect()}
    assert len(got) == len(rows)
    right = sum(got[i].language == lang for i, _, _, _, lang in rows if lang)
    assert right >= 0.98 * sum(lang is not None for *_, lang in rows)
    assert not got[600].kept and not got[601].kept and not got[602].kept and not got[603].kept
    assert got[600].language == "aa" and got[604].language == "aa" and got[604].kept


def test_posterior_like_brute_force(tongues):
    rows, df = tongues
    model = language.train(df)
    keys = ["lang", "none", "none2", "source"]
    whole = df.selectExpr("*", "cast(null as string) as none", "cast(null as string) as none2")
    scored = language.score(whole, model)
    rows_in = scored.collect()
    k = len(model.languages)
    best = [int(np.argmax(r["__text"])) for r in rows_in]
    counted = [(r, b) for r, b in zip(rows_in, best) if r["__letters"] > 0]
    every = Counter(b for _, b in counted)
    total = len(counted)
    base = [(every[i] + 1) / (total + k) for i in range(k)]
    declared = {r.lang for r, _ in counted}
    got = {tuple(r[c] for c in keys): r["__prior"] for r in language.evidence(scored, model, keys).collect()}
    for r in rows_in:
        host = Counter(b for q, b in counted if q.source == r.source)
        said = Counter(b for q, b in counted if q.lang == r.lang)
        up = Counter(b for q, b in counted)  # null suffix and parent: all documents
        for i in range(k):
            parent = (up[i] + 20 * base[i]) / (sum(up.values()) + 20)
            want = math.log((host[i] + 20 * parent) / (sum(host.values()) + 20))
            if r.lang is not None:
                want += math.log((said[i] + 1) / (every[i] + len(declared) + 1))
            assert got[r.lang, None, None, r.source][i] == pytest.approx(want)


def _spoken(rng, sounds, n):
    return "".join(rng.choice(sounds) for _ in range(n))


def test_rare_languages_are_languages(spark):
    rng = random.Random(12)
    rows = [(i, _spoken(rng, "bcdlou e", 60), "aa", "s") for i in range(11_950)]
    rows += [(i, _spoken(rng, "xyzwqk j", 60), "rr", "s") for i in range(20_000, 20_050)]  # 0.4 %
    rows += [(i, _spoken(rng, "fghmv pt", 60), "qq", "s") for i in range(30_000, 30_030)]  # too few to tell from slips
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(8)
    got = {r.doc_id: (r.language, r.kept) for r in language.identify(df, sample=200).collect()}
    assert sum(got[i] == ("rr", True) for i in range(20_000, 20_050)) >= 48
    assert sum(got[i] == ("aa", True) for i in range(11_950)) >= 11_800
    assert not any(got[i][1] for i in range(30_000, 30_030) if got[i][0] == "qq")
    few = df.where("doc_id % 100 = 0 or doc_id between 20000 and 20002")  # of a small table, a share
    assert "rr" in language.train(few).languages


def test_evidence_of_pages(spark):
    made = [
        ("https://a.site.de/x?y=http://b.fr", "<!doctype html><HTML class='l' lang=\"de-AT\"><p>x"),
        ("http://user:pw@WWW.Site.CO.UK:80/", "<html xml:lang='fr'><body lang='en'>"),
        ("http://10.0.0.1/x", "<html\nlang=fr-FR >"),
        ("ftp://localhost", "<html data-lang='xx'>"),
        ("no address", None),
        (None, "<p lang='de'>"),
        ("http://host.", "<html lang=''>"),
    ]
    df = spark.createDataFrame(made, "url string, html string").selectExpr("*", "1 as suffix")
    got = [(r.host, r.parent, r.suffix, r.declared) for r in language.of_pages(df).collect()]
    assert got == [
        ("a.site.de", "site.de", "de", "de-AT"),
        ("www.site.co.uk", "co.uk", "uk", None),
        ("10.0.0.1", None, None, "fr-FR"),
        ("localhost", None, "localhost", None),
        (None, None, None, None),
        (None, None, None, None),
        ("host", None, "host", None),
    ]


def test_suffix_and_domain_evidence_like_brute_force(spark):
    rng = random.Random(5)
    sounds = {"aa": "bcdlou", "bb": "nprst aei", "cc": "xyzwqk uo"}
    rows = []
    for i in range(500):
        lang = rng.choice(list(sounds))
        suffix = {"aa": "ax", "bb": "bx", "cc": rng.choice(["bx", "cx"])}[lang] if i % 5 else None
        parent = f"p{rng.randrange(3)}.{suffix}" if suffix else None
        page = f"<html{f' lang={lang}' if i % 3 else ''}><p>{_spoken(rng, sounds[lang], rng.randint(0, 60))}"
        rows.append((i, f"http://h{rng.randrange(4)}.{parent}/" if parent else f"http://10.0.0.{rng.randrange(3)}/", page))
    pages = html_text.main_text(language.of_pages(spark.createDataFrame(rows, "page_id long, url string, html string")))
    keys = ["declared", "suffix", "parent", "host"]
    model = language.train(pages, "declared")
    assert model.languages == ["aa", "bb", "cc", "und"]
    scored = language.score(pages, model)
    held = scored.collect()
    counted = [(r, int(np.argmax(r["__text"]))) for r in held if r["__letters"] > 0]
    k, every = len(model.languages), Counter(b for _, b in counted)
    base = [(every[i] + 1) / (len(counted) + k) for i in range(k)]
    many = {c: len({r[c] for r, _ in counted}) for c in keys}
    got = {tuple(r[c] for c in keys): r["__prior"] for r in language.evidence(scored, model, keys).collect()}
    assert any(s and p for _, s, p, _ in got)
    for r in held:
        same = lambda *by: Counter(b for q, b in counted if all(q[c] == r[c] for c in by))
        host, up = same("suffix", "parent", "host"), same("suffix", "parent")
        for i in range(k):
            parent = (up[i] + 20 * base[i]) / (sum(up.values()) + 20)
            want = math.log((host[i] + 20 * parent) / (sum(host.values()) + 20))
            for c in ("declared", "suffix"):
                if r[c] is not None:
                    want += math.log((same(c)[i] + 1) / (every[i] + many[c] + 1))
            assert got[tuple(r[c] for c in keys)][i] == pytest.approx(want)
    found = language.identify(pages, "declared", "host", "suffix", "parent", keep=["page_id"]).collect()
    assert sum(r.language == next(x for x, s in sounds.items() if set(rows[r.page_id][2].split("<p>")[1]) <= set(s)) for r in found if len(rows[r.page_id][2]) > 60) > 100


def test_language_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert language.identify(none).count() == 0
    undeclared = spark.createDataFrame([(1, "some text", None, "s")], "doc_id long, text string, lang string, source string")
    assert [(r.language, r.kept) for r in language.identify(undeclared).collect()] == [("und", False)]


def test_trigrams_count_letters():
    letter = language._letters()
    assert len(language.trigrams("ab, c1", letter)) == 3
    assert len(language.trigrams(None, letter)) == len(language.trigrams("12 ..", letter)) == 0


# grades


def test_held_out_grades(spark):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    rows, ratings = [], []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 300))]
        rating = rng.choice([0, 1, 2, 2, 2])
        for _ in range(2 - rating):
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vile"]))
            words.append("###")
        if rating == 0:
            words += ["SHOUT", "worse"] * 3
        rows.append((i, " ".join(words)))
        if i % 3:
            ratings.append((i, rating))
    truth = dict(ratings) | {}
    docs = spark.createDataFrame([*rows, (9000, None), (9001, ""), (5, "a repeated id")], "doc_id long, text string")
    model = ordinal.train(docs, spark.createDataFrame([*ratings, (None, 1), (7, None), (1, 9)], "doc_id long, grade int"), "grade")
    got = ordinal.grade(docs.selectExpr("*", "0 as expected_grade"), model).collect()
    assert len(got) == len(rows) + 3
    held = [(r, rows[r.doc_id][1]) for r in got if r.doc_id < 1500 and r.doc_id not in truth and r.text != "a repeated id"]
    right = sum((r.tail_probability >= 0.5) == ("###" not in t) for r, t in held)
    assert right >= 0.97 * len(held)
    low = np.mean([r.expected_grade for r, t in held if "worse" in t])
    middle = np.mean([r.expected_grade for r, t in held if "###" in t and "worse" not in t])
    high = np.mean([r.expected_grade for r, t in held if "###" not in t])
    assert low < middle - 0.5 < high - 1


def test_cumulative_probabilities():
    m = ordinal.Model(np.zeros(1 << ordinal.BITS, np.float32), np.array([-1.0, 0.5]))
    tails = m.tails(np.array([0.0, 3.0]))
    assert tails[0] == pytest.approx([1 / (1 + math.exp(-1)), 1 / (1 + math.exp(0.5))])
    assert (np.diff(tails, axis=1) < 0).all() and (np.diff(tails, axis=0) > 0).all()


def test_fit_is_the_most_likely_model_by_brute_force(monkeypatch):
    """Against a search that knows the likelihood only."""
    monkeypatch.setattr(ordinal, "LEAST", 1)
    monkeypatch.setattr(ordinal, "LEAN", 0.0)
    rng = random.Random(19)
    bags, grades = [], []
    for _ in range(120):
        bag = [f for f in range(3) if rng.random() < 0.5]
        score = sum((1.5, -1.0, 0.3)[f] for f in bag) + math.log(1 / rng.uniform(0.01, 0.99) - 1)
        bags.append(np.array(bag, np.int32))
        grades.append(sum(score > c for c in (-0.5, 1.0)))
    model = ordinal.fit(bags, np.array(grades), 2)

    def loss(w, cuts):
        total = 0.0
        for bag, g in zip(bags, grades):
            z = sum(w[f] for f in bag)
            tail = [1.0, *(1 / (1 + math.exp(c - z)) for c in cuts), 0.0]
            total -= math.log(max(tail[g] - tail[g + 1], 1e-12))
        return total / len(bags) + ordinal.SHRINK / 2 * sum(x * x for x in w)

    at, step = [0.0, 0.0, 0.0, -0.5, 0.5], 0.5
    best = loss(at[:3], at[3:])
    while step > 1e-4:
        moved = False
        for i in range(5):
            for d in (step, -step):
                new = [x + d * (k == i) for k, x in enumerate(at)]
                if new[3] <= new[4] and (value := loss(new[:3], new[3:])) < best - 1e-12:
                    at, best, moved = new, value, True
        step = step if moved else step / 2
    assert loss(model.weights[:3].tolist(), model.cuts.tolist()) == pytest.approx(best, abs=2e-4)
    assert model.weights[:3].tolist() == pytest.approx(at[:3], abs=0.1) and model.cuts.tolist() == pytest.approx(at[3:], abs=0.1)
    assert not model.weights[3:].any()


def test_grades_without_two_ratings(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for ratings, want in (([], 1.0), ([(1, 2)], 1.0), ([(1, 0), (2, 0)], 0.0)):
        model = ordinal.train(docs, spark.createDataFrame(ratings, "doc_id long, grade int"), "grade")
        assert all(r.tail_probability == pytest.approx(want, abs=1e-6) for r in ordinal.grade(docs, model).collect())
    assert ordinal.grade(docs.limit(0), model).count() == 0


# rules


def _brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    count = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics_like_brute_force(spark):
    texts = [*ODD, "a a a a", "a b c a b c a b", " \x0b\x0c\r\t\n ", "x|y\n\nx|y\nx|y \\ \"q\" f's", "q " * 3000, "\n".join(["same line here"] * 4)]
    rng = random.Random(6)
    texts += [" ".join(rng.choice("abcde") for _ in range(n)) for n in (1, 2, 3, 40, 700)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as kept")
    got = {r.doc_id: tuple(r[c] for c in decision_list.BASE) for r in decision_list.statistics(df).collect()}
    assert got == {i: _brute_statistics(t) for i, t in enumerate(texts)}
    assert decision_list.statistics(df.limit(0)).count() == 0


def _noisy(rng, bad):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 200))]
    return " ".join(f"{w}###" if bad and rng.random() < 0.5 else w for w in words)


def test_rules_are_learned_and_hold(spark):
    rng = random.Random(7)
    rows = [(i, _noisy(rng, i % 4 == 0), int(i % 4 != 0)) for i in range(400)]
    rows += [(900, None, 1), (901, "", 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:300]] + [(None, 0), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in decision_list.apply_rules(docs, labels).collect()}
    assert all(got[i].kept == bool(q) and not got[i].base_failed for i, _, q in rows[300:400])
    assert got[900].base_failed and not got[901].kept
    rules = decision_list.learn(decision_list.statistics(docs), labels)
    assert any("n_symbols" in c.sql() or "n_marks" in c.sql() for r in rules for c in r)


def _features(rng, kind):
    """(symbols, marks, capitals, repeats, duplicate lines, length) shares of a kind of document."""
    clean = [rng.random() * 0.02, rng.random() * 0.03, rng.random() * 0.1, 0.0 if rng.random() < 0.9 else rng.random() * 0.05, 0.0, 4 + rng.random() * 2]
    if kind == "common":
        clean[0] = 0.1 + rng.random() * 0.5
    if kind == "rare":
        clean[4] = 0.3 + rng.random() * 0.4
    if kind == "rarest":
        clean[5] = 11 + rng.random()
    return clean


@pytest.mark.parametrize("rare, rarest", [(0.1, 0.0), (0.1, 0.01), (0.01, 0.01)])
def test_rare_junk_gets_rules_of_its_own(spark, monkeypatch, rare, rarest):
    rng = random.Random(14)
    monkeypatch.setattr(decision_list, "FEATURES", {f: f for f in "abcdef"})
    kinds = ["good"] * 6000 + ["rare"] * int(3000 * rare) + ["rarest"] * int(3000 * rarest)
    kinds += ["common"] * (9000 - len(kinds))
    rows = [(i, 100, 0, k, *_features(rng, k)) for i, k in enumerate(kinds)]
    stats = spark.createDataFrame(rows, "doc_id long, n_words long, n_repeat_words long, kind string, a double, b double, c double, d double, e double, f double").repartition(4)
    slips = {i for i in range(6000) if i % 200 == 0}
    labels = spark.createDataFrame([(i, int((k == "good") != (i in slips))) for i, k in enumerate(kinds)], "doc_id long, quality int")
    rules = decision_list.learn(stats, labels)
    kept = Counter(r.kind for r in stats.where(decision_list.verdict(rules)).collect())
    many = Counter(kinds)
    assert kept["good"] >= 0.99 * many["good"], rules
    for kind in ("common", "rare", "rarest"):
        assert kept[kind] <= 0.02 * many[kind], (kind, rules)


def test_noise_gives_no_rules(spark):
    rng = random.Random(15)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(70))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, rng.randint(0, 1)) for i in range(600)], "doc_id long, quality int")
    got = decision_list.apply_rules(docs, labels).collect()
    assert sum(r.kept or r.base_failed for r in got) >= 590


def test_conditions_like_brute_force(spark, monkeypatch):
    rng = random.Random(16)
    monkeypatch.setattr(decision_list, "FEATURES", {"a": "a", "b": "b"})
    rows = [(rng.random() < 0.4, rng.random() < 0.7, float(rng.randrange(12)), rng.random()) for _ in range(300)]
    rows = [(bad or a > 9, g, a, b) for bad, g, a, b in rows]
    known = spark.createDataFrame(rows, "bad boolean, growing boolean, a double, b double")
    got = decision_list.candidates(known)
    grown = [r for r in rows if r[1]]
    p0, n0 = (sum(r[0] == x for r in grown) for x in (True, False))
    best = {}
    for gain, c, p, n in got:
        at = {"a": 2, "b": 3}[c.feature]
        held = [r for r in grown if (r[at] > c.threshold) == c.above]
        assert (p, n) == (sum(r[0] for r in held), sum(not r[0] for r in held))
        assert gain == pytest.approx(p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))))
        best[c.feature, c.above] = gain
    values = sorted({r[2] for r in grown})  # every cut of the feature of few values is tried
    for above in (True, False):
        gains = []
        for cut in values[:-1]:
            held = [r for r in grown if (r[2] > cut) == above]
            p = sum(r[0] for r in held)
            gains.append(p * (math.log2(p / len(held)) - math.log2(p0 / (p0 + n0))) if p else 0)
        if max(gains) > 1e-9:
            assert best["a", above] == pytest.approx(max(gains))
    assert [g for g, *_ in got] == sorted((g for g, *_ in got), reverse=True)
    rule = decision_list.next_rule(known)
    assert rule == (decision_list.Condition("a", True, 9.5),)


def test_rules_without_labels_keep_what_passes(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "short")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in decision_list.apply_rules(docs, none).collect()} == {1: True, 2: False}


def test_rules_run_no_python(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = decision_list.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# pages


def test_pages_of_the_table(spark):
    from html import unescape

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = re.sub(r"<(p|br|h1)>|</(p|h1)>", " ", re.sub(r"</?b>", "", article))
        assert html_text.extract(r.html) == " ".join(unescape(blocks).split())


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain words &amp; no markup", "plain words & no markup"),
        ("<p>a<b>b</b><br>c &amp;lt; x < 3 &eacute;&nbsp;&#x41;</p>", "ab c &lt; x < 3 é A"),
        ("<p>one<p>two<ul><li>three<li>four</ul>", "one two three four"),
        ('<body><div class="cookie-notice">no</div><article><p>yes</p><!-- <p>no</p> --><form><p>no</p></form></article><div id="comments">no</div>', "yes"),
        ("<div><script>if (a<b) { '</p>' }</script><style>p{}</style><p>kept</p></div>", "kept"),
        ("<article><h1>Head</h1><p>body text</p></article><footer>foot", "Head body text"),
        ("<article><p>cut off here</p><p>and <a href='x", "cut off here and"),
        ("<ARTICLE><P>Case\n  and\tspace</P></ARTICLE>", "Case and space"),
        ("<article><p>x</p><p>x</p></article>", "x x"),
        ("<body><div class='site-header'>Site</div><article><header><h1>Head</h1></header><p>text</p></article></body>", "Head text"),
        ("<body><aside>no</aside><main><h1>Head</h1><p>one</p><div class='promo box'>no</div><p>two</p></main><section id='comments'><p>no</p></section></body>", "Head one two"),
        ("<body><div role='navigation'>no</div><div id=cookieBanner>no</div><div><p>yes &lt;b&gt;</p></div></body>", "yes <b>"),
    ],
)
def test_page_text(page, text):
    assert html_text.extract(page) == text


def test_dense_block_wins_without_names():
    links = "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(30))
    body = "".join(f"<p>{'sentence of an article ' * 8}{i}.</p>" for i in range(6))
    page = f"<body><div><ul>{links}</ul></div><div>{body}</div><div><ul>{links}</ul></div></body>"
    got = html_text.extract(page)
    assert "link number" not in got and got.count("article") == 48


def test_all_of_an_article_is_text():
    p = "sentence of an article " * 13
    first, second = (f"<section>{f'<p>{p}</p>' * n}</section>" for n in (5, 3))
    rest = "<h2>Second head</h2><ul><li>item one</li><li>item two</li></ul><blockquote>Quoted words</blockquote><pre>code</pre><table><tr><td>cell</td></tr></table><section><p>short end</p></section>"
    want = " ".join(["The title Lead", *[p.strip()] * 8, "bare words Second head item one item two Quoted words code cell short end"])
    links = "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(30))
    for name in ("article", "main", "div"):
        page = f"<body><ul>{links}</ul><{name}><h1>The title</h1>Lead{first}{second}bare words{rest}</{name}><ul>{links}</ul></body>"
        assert html_text.extract(page) == want


@pytest.mark.parametrize(
    "wrapper",
    ["div class='container has-sidebar'", "div class='content no-sidebar'", "div id='page' class='menu-open'", "div class='post-with-comments'", "section class='article widget'", "form action='/' id=aspnetForm"],
)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<h1>Head</h1>{}", "{}"])
def test_wrappers_named_after_other_blocks_are_not_cut(wrapper, inner):
    p = "sentence of an article " * 13
    body = inner.format(f"<p>{p}</p><p>{p}</p>")
    page = f"<body><{wrapper}><div class='sidebar'>no</div>{body}<form><p>no</p></form><div id='comments'><p>no {'x' * 99}</p></div></{wrapper.split()[0]}></body>"
    assert html_text.extract(page) == " ".join(["Head"] * ("h1" in inner) + [p.strip()] * 2)


def test_deep_and_long_pages(spark):
    deep = "<div>" * 5000 + "<p>deep text</p>"
    long = "<article>" + "<p>paragraph text</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", deep, "x"), (2, "u", long, "y"), (3, None, None, None)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.main_text(df, keep=["page_id", "url"]).collect()}
    assert got[1].text == "deep text" and got[2].n_chars == 20_000 * 15 - 1 and got[3].n_chars == 0


# licences


def _brute_licenses(text, templates, threshold):
    words = licenses.normalise(text)
    best = {}
    for name, t in templates.items():
        w = licenses.normalise(t)
        bag = {*zip(w, w[1:])}
        for a in range(len(words)):
            for b in range(a + 2, len(words) + 1):
                own = {*zip(words[a:b], words[a + 1 : b])}
                dice = 2 * len(own & bag) / (len(own) + len(bag))
                if dice >= threshold:
                    best[name] = max(best.get(name, 0), dice)
    return best


def test_best_spans_like_brute_force():
    rng = random.Random(8)
    vocabulary = "the licence of this work is free to use and share".split()
    templates = {f"t{k}": " ".join(rng.choice(vocabulary) for _ in range(n)) for k, n in enumerate((3, 5, 8, 12))}
    scanner = licenses.Scanner(templates)
    for _ in range(40):
        words = [rng.choice(vocabulary + ["other"]) for _ in range(rng.randint(0, 25))]
        words[5:5] = templates[rng.choice(list(templates))].split()
        got = scanner.scan(" ".join(words))
        want = _brute_licenses(" ".join(words), templates, licenses.THRESHOLD)
        assert bool(got) == bool(want)
        if want:
            assert max(f["dice"] for f in got) == pytest.approx(max(want.values()))


def test_templates_find_themselves_and_near_copies(spark):
    rows = []
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        rows.append((i, f"Some words before.\n{text.upper()}\nand after", name))
        if len(text.split()) > 40:
            rows.append((100 + i, text.replace("software", "program", 1), name))
    rows += [(900, None, None), (901, "", None), (902, "no notice at all, licensed or under", None), (903, "Released under the MIT License. " * 4000, None), (904, "the MIT License, the MIT License, " * 4000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(df, keep=["doc_id"]).collect()}
    for i, _, name in rows:
        if name:
            assert [f.license for f in got[i]] == [name]
    assert got[900] == got[901] == got[902] == []
    assert len(got[903]) == 4000 and {f.license for f in got[903]} == {"MIT notice"} and got[904] == []
    with pytest.raises(ValueError):
        licenses.Scanner({"x": "word"})


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h1>T</h1><p>One text of some words.</p><section class='related-work'><p>Kept work.</p></section><section class='search-methods'><p>Kept methods.</p></section><section class='notice-period'><p>Kept period.</p></section></article>", "T One text of some words. Kept work. Kept methods. Kept period."),
        ("<article><p>One text of some words.</p><div class='related-posts'>no</div><div class='share-buttons'>no</div><div id='comments'>no</div><div class='ad-slot'>no</div></article>", "One text of some words."),
        ("<div class='content'><header><h1>Title</h1></header><p>A text of several words, and more.</p><p>Another one of them, too.</p></div>", "Title A text of several words, and more. Another one of them, too."),
        ("<body><header><h1>Site</h1></header><article><h1>Title</h1><p>A text of several words.</p></article></body>", "Title A text of several words."),
        ("<article><p>A text of several words.</p><div class='usercomments'><p>no</p></div><ol class='commentlist'><li>no</ol><section class='readerComments'>no</section></article>", "A text of several words."),
        ("<article><p>A text of several words.</p><p class='commentary'>Kept comment.</p><p class='shareholders'>Kept too.</p><article class='comment-body'><p>no</p></article></article>", "A text of several words. Kept comment. Kept too."),
        ("<body><div><article><h2>One</h2><p>The first text, of several words.</p></article><article><h2>Two</h2><p>The second text.</p></article><article><a href='x'>A teaser of another page</a></article></div></body>", "One The first text, of several words. Two The second text."),
        ("<main><div class='user-comments'>no</div><p>A text <b>of several</b> words.<p>More of them.</main>", "A text of several words. More of them."),
        ("<article><ul><li>one<ul><li>two<li>three</ul><li>four</ul><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e<dt>f</dl></article>", "one two three four a b c d e f"),
        ("</p></div><article><p>A text</i> of</section> words.</p></article></html></b>", "A text of words."),
    ],
)
def test_articles_are_whole_and_without_comments(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize("a, b", [("<b>", "<p>x"), ("<b>", "</i>"), ("<p><td><b>", "<p>x</p>"), ("<table><td><b>", "<td>x"), ("<ul><li>", "<li>x"), ("<dl><dt><i>", "<dd>x"), ("<p>", "<p>"), ("<div class='usercommentlistusercommentlist'>", "</div>"), ("<article><a>x</a></article>", "<p>y")])
def test_time_grows_with_the_page(a, b):
    import time

    def took(n):
        page, start = a * n + b * n, time.process_time()
        html_text.extract(page)
        return time.process_time() - start

    assert took(40_000) < 12 * max(took(10_000), 0.02)


SIBLINGS = {
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": "licensed under cc by-nc-sa 4.0",
}


def test_siblings_keep_their_names():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in {**licenses.TEMPLATES, **SIBLINGS}.items():
        got = scanner.scan(f"Some words before. {text} Others behind, and more of them.")
        assert [f["license"] for f in got] == [name], name


def test_long_repeated_words_take_time_in_proportion():
    import time

    scanner = licenses.Scanner(licenses.TEMPLATES)
    for words in ("released under ", "licensed under the gnu general public license ", "the software is provided ", licenses.TEMPLATES["MIT"] + " "):
        text = words * (20_000 // len(words.split()) + 1)
        start = time.process_time()
        scanner.scan(text + "Released under the MIT License.")
        assert time.process_time() - start < 6
