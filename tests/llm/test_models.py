"""Language id, secrets, language model, toxicity, top-k: brute force, held-out quality and awkward cases."""

import base64
import bz2
import gzip
import hashlib
import lzma
import math
import random
import re
import time
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marshlight.llm import language, lm, secrets, topk, toxicity
from marshlight.llm.queries import QUERIES
from tests.llm.frames import awkward, documents, empty

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_language_held_out(spark):
    out = QUERIES["op4_language_id"](spark, SF).where("held_out").join(table(spark, "documents").select("doc_id", "lang"), "doc_id")
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.97


def test_language_of_awkward_tables(spark):
    net = language.fit_language(awkward(spark), sample_docs=50)
    out = language.identify_language(awkward(spark), net).collect()
    assert len(out) == 13 and all(0 <= r["score"] <= 1 for r in out)
    assert {r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 3, 8)} == {"und"}
    assert language.fit_language(empty(spark)) is None
    assert language.identify_language(awkward(spark), None).where("lang_pred != 'und'").count() == 0
    assert language.identify_language(empty(spark), net).count() == 0


def test_sample_of_languages_is_by_label_and_row(spark):
    good = [(5, f"das ist ein satz mit der nummer {i} und mehr", "de", "a") for i in range(3000)] + [(5, f"voici la phrase numero {i} et plus", "fr", "a") for i in range(2)]
    for rows in (good, good + [(None, None, "de", "a")] * 3000, good + [(None, "", "fr", "b")] * 3000, good + [(8, "immer derselbe satz", "de", "a")] * 6000):
        net = language.fit_language(documents(spark, rows), sample_docs=1000)
        assert net.languages == ["de", "fr"]
        out = language.identify_language(documents(spark, [(1, "das ist ein satz und mehr", None, None)]), net).first()
        assert out["lang_pred"] == "de"
    same = documents(spark, good)
    one, other = (language.fit_language(df, sample_docs=300) for df in (same.coalesce(1), same.repartition(7)))
    assert all(np.array_equal(one.tables[w], other.tables[w]) for w in language.WIDTHS)


def test_windows_hold_the_whole_text():
    raw = bytes(range(1, 250)) * 3
    assert language.cut(raw).tobytes().rstrip(b" ") == raw and language.cut(b"").shape == (1, language.WINDOW)


def test_filters_are_sums_of_table_rows():
    rng = np.random.default_rng(0)
    net = language.ByteNetwork.start(["a", "b"], 3)
    rows = rng.integers(0, 256, (5, 40), dtype=np.uint8)
    got, _ = net.pooled(rows)
    for k, w in enumerate(language.WIDTHS):
        want = [[max(0, max(sum(net.tables[w][j][r[p + j], f] for j in range(w)) for p in range(40 - w + 1))) for f in range(language.FILTERS)] for r in rows]
        assert np.allclose(got[:, k * language.FILTERS:(k + 1) * language.FILTERS], want, atol=1e-5)


def spans(text):
    return [(secrets.KINDS[k], text[s:e]) for s, k, e in secrets.all_spans(text)[1]]


def test_base_patterns():
    assert spans("password=abcdefghijkl") == [("assign", "password=abcdefghijkl")]
    assert spans("password=short token: 'AAAABBBBCCCC'") == [("assign", "token: 'AAAABBBBCCCC")]
    assert spans("token=secret=abcdefghijkl") == [("assign", "token=secret=abcdefghijkl")]
    assert spans("API_KEY = \"Zz09Zz09Zz09\" apikey:abcdefghijk") == [("assign", "API_KEY = \"Zz09Zz09Zz09")]
    assert spans("xAKIA12345678901234 AKIA1234567890") == [("access", "AKIA12345678901234")]
    assert spans("0123456789abcdef 0123456789abcde") == [("hex", "0123456789abcdef")]
    assert secrets.all_spans("") == ([], [])


def test_layers_are_unwrapped_and_mapped():
    plain = "password=abcdefghijkl"
    url = urllib.parse.quote(plain, safe="")
    assert ("assign", url) in spans(f"ein {url} aus")
    assert ("assign", urllib.parse.quote(url)) in spans(f"é {urllib.parse.quote(url)} aus")  # twice
    escaped = "".join(f"\\u{ord(c):04x}" for c in plain)
    assert ("assign", escaped) in spans(f"x {escaped}")
    b64 = base64.b64encode(b"key AKIA12345678901234 end of it").decode()
    assert [k for k, _ in spans(f"see {b64} here")] == ["access"]
    for packed in (gzip.compress(plain.encode()), zlib.compress(zlib.compress(plain.encode()))):
        run = base64.b64encode(packed).decode()
        assert ("assign", run) in spans(f"blob {run} end")
    nested = base64.b64encode(urllib.parse.quote(base64.b64encode(plain.encode()).decode(), safe="").encode()).decode()
    assert any(k == "assign" for k, _ in spans(nested))
    assert spans("%25" * 50 + " " + "a" * 200 + " %zz \\u12 &#99999999; =") == [("hex", "a" * 200)]


def test_escapes_are_decoded_across_blanks():
    assert spans("a password%3A hunter2hunter22 b") == [("assign", "password%3A hunter2hunter22")]
    assert spans('x "token"\\u003a "abcdefghijkl0123" y') == [("assign", 'token"\\u003a "abcdefghijkl0123')]


def test_base64_in_lines_and_behind_names():
    words = " ".join(f"w{i}" for i in range(40))
    plain = f"{words} password=abcdefghijkl {words}".encode()
    whole = base64.b64encode(plain).decode()
    for end in ("\n", "\r\n", "\n  "):
        for width in (64, 76):
            wrapped = end.join(whole[i:i + width] for i in range(0, len(whole), width))
            assert "assign" in [k for k, _ in spans(f"mail\n\n{wrapped}\n\nend")]
    packed = base64.b64encode(gzip.compress((" ".join(f"{i * 7919 % 1000}" for i in range(300)) + " AKIA12345678901234 end").encode())).decode()
    wrapped = "\n".join(packed[i:i + 76] for i in range(0, len(packed), 76))
    assert len(packed) > 200 and ("access", wrapped) in spans(f"blob:\n{wrapped}\nend of it")
    b64 = base64.b64encode(b"key AKIA12345678901234 end of it").decode()
    for around in ("key_{}", "http://a.b/path/{}", "a/long/segment-name/{}", "x-{}", "some/{}/more", "some_{}_more"):
        found = spans(around.format(b64.rstrip("=")))
        assert [k for k, _ in found] == ["access"] and found[0][1] in b64


def test_nested_escapes_take_linear_time():
    secret = "password=abcdefghijkl"
    for lead in ("%" + "25" * 4000 + "3D", "\\" + "u005c" * 1600 + "u003d", "&#" + "38;#" * 2000 + "61;", "%" * 3000 + "3" * 3000 + "d"):
        text = f"ein password{lead}abcdefghijkl aus"
        began = time.perf_counter()
        assert ("assign", text[4:-4]) in spans(text)
        assert time.perf_counter() - began < 1
    long = "%" + "25" * 500_000 + "41"
    began = time.perf_counter()
    secrets.all_spans(long)
    assert time.perf_counter() - began < 20
    assert secret in {inner for inner, _, _ in secrets.layers("".join(f"%25252525252525252525{ord(c):02x}" for c in secret))}


@pytest.mark.parametrize("seed", range(20))
def test_one_pass_and_single_steps_agree(seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = "".join(rng.choice("aé %;&#x1") for _ in range(rng.randint(1, 8)))
        for _ in range(rng.randint(1, 4)):
            hide = [lambda c: "".join(f"%{b:02X}" for b in c.encode()), lambda c: f"\\u{ord(c):04x}", lambda c: f"&#{ord(c)};", lambda c: c, lambda c: c]
            text = "".join(rng.choice(hide)(c) for c in text)
        plain, first, final = text, np.arange(len(text)), np.arange(1, len(text) + 1)
        for _ in range(60):
            inner, begins, stops = secrets._unescape(plain)
            if inner == plain:
                break
            plain, first, final = inner, first[begins], final[stops - 1]
        settled = secrets._settle(text)
        if "Ã" not in plain + settled[0]:  # bytes that no step brought together
            assert settled[0] == plain
            assert settled[1].tolist() == first.tolist() and settled[2].tolist() == final.tolist()


def test_compressed_layers_of_any_size_depth_and_spelling():
    secret = b"x password=abcdefghijkl y"
    big = b"lorem ipsum dolor\n" * 1_000_000 + secret
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        run = base64.b64encode(pack(big)).decode()
        assert ("assign", run) in spans(f"see {run} end")
        raw = pack(secret)
        url = urllib.parse.quote(raw, safe="")
        assert ("assign", url) in spans(f"see {url} end")
        written = repr(raw)[2:-1]
        assert ("assign", written) in spans(f"see {raw!r} end")
    run = base64.b64encode(gzip.compress(b"first member ") + gzip.compress(secret)).decode()
    assert ("assign", run) in spans(f"see {run} end")
    deep = secret
    for _ in range(40):
        deep = zlib.compress(deep)
    run = base64.b64encode(deep).decode()
    assert ("assign", run) in spans(f"see {run} end")
    for odd in ("a\u00a0b \u200b\x01 password=abcdefghijkl", "\ufeffpassword=abcdefghijkl"):
        assert [k for k, _ in spans(f"see {base64.b64encode(odd.encode()).decode()} end")] == ["assign"]
    latin = base64.b64encode(gzip.compress("schlüssel password=abcdefghijkl".encode("latin-1"))).decode()
    assert ("assign", latin) in spans(f"see {latin} end")
    assert [k for k, _ in spans(base64.b64encode(b"x^2 password=abcdefghijkl").decode())] == ["assign"]  # begins like zlib data


def test_base_columns_of_a_whole_table(spark):
    rules = [(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12), (r"(AKIA[A-Z0-9]+)", 18), (r"([0-9a-f]+)", 16)]
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    out = QUERIES["op6_secret_scan"](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        found = [sorted((m.start(), k, m.end()) for m in re.finditer(p, texts[r["doc_id"]]) if len(m[1]) >= least) for k, (p, least) in enumerate(rules)]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [len(f) for f in found]
        listed = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(sum(found, [])))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert not listed or set(listed.split(",")) <= set(r["spans"].split(","))


def test_secrets_of_awkward_tables(spark):
    out = secrets.scan_secrets(awkward(spark)).collect()
    assert len(out) == 13 and {r["base"] for r in out} == {""}
    assert secrets.scan_secrets(empty(spark)).count() == 0
    one = secrets.scan_secrets(documents(spark, [(1, "é token=abcdefghijkl0123456789abcdef", None, None)])).first()
    assert one["base"] == "assign:2:36,hex:20:36" and (one["n_assign"], one["n_hex"]) == (1, 1)


def test_network_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    net = lm.train([rng.integers(0, 20, 400) for _ in range(5)], np.full(20, 0.05), 19)
    far, near = rng.integers(0, 20, 30), rng.integers(0, 20, 30)
    p = sum(np.exp(net.log_probability(far, near, np.full(30, w))) for w in range(20))
    assert np.allclose(p, 1, atol=1e-3)


def test_shards_are_dealt_once_for_all_rounds(spark, monkeypatch):
    """Contexts counted from coded texts are those of plain loops; however many rounds, their shards are shuffled once."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "b", "cc", "rare1", "rare2", "xyz"], rng.integers(0, 9))) for _ in range(200)] + [None, ""]
    codes = {b"a": 0, b"b": 1, lm.END: 2, b"cc": 3}  # own classes a, b and the end; cc and kinds of endings are of classes 3 and 4
    class_of = np.concatenate([[0, 1, 2, 3], 3 + np.arange(lm.SPELLINGS) % 2])
    kind = lambda w: int(class_of[codes.get(w, 4 + lm.spelling(w))])
    expected = Counter()
    for text in texts:
        seen = [2, 2, *map(kind, lm.tokens(text))]
        expected.update((f * 5 + n) * 5 + w for f, n, w in zip(seen, seen[1:], seen[2:]))
    docs = documents(spark, [(i, x, "", "") for i, x in enumerate(texts)])
    counted = lm.count_contexts(lm.coded_texts(docs, codes, 4), class_of, 5, 2).cache()
    assert {r["context"]: r["n"] for r in counted.collect()} == expected
    dealt, plain = [], type(counted).repartition
    monkeypatch.setattr(type(counted), "repartition", lambda self, *a: dealt.append(a) or plain(self, *a))
    net = lm.train_on(counted, np.full(5, 0.2), np.arange(lm.SPELLINGS) % 2, np.full(2, 0.1), rounds=3, shard=20)
    assert len(dealt) == 1 and np.isfinite(net.normaliser).all()


def test_sums_by_key_are_those_of_loops():
    rng = np.random.default_rng(7)
    for keys in (np.array([5]), rng.integers(0, 2**31 - 1, 50).repeat(3), rng.integers(0, 9, 400)):
        rows = rng.random((len(keys), 3)).astype(np.float32)
        places, sums = lm.sum_by(keys, rows)
        assert places.tolist() == sorted(set(keys.tolist()))
        assert np.allclose(sums, [rows[keys == k].sum(axis=0) for k in places])


def test_network_learns_order():
    chain = [np.array([0, 1, 2, 3] * 300) for _ in range(4)]
    net = lm.train(chain, np.full(5, 0.2), 4, epochs=30)
    assert np.exp(net.log_probability(np.array([0]), np.array([1]), np.array([2])))[0] > 0.6


def test_scores_against_brute_force(spark):
    docs = table(spark, "documents").where("doc_id < 300")
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    folds = {r[0]: r[1] for r in docs.select("doc_id", lm.fold_share(F.col("doc_id"), 10)).collect()}
    assert all(folds[i] == zlib.crc32(str(i).encode()) % 10 for i in rows)
    count = Counter(t for i, x in rows.items() if folds[i] for t in lm.tokens(x))
    n, v = sum(count.values()), len(count)
    train_docs = docs.where(lm.fold_share(F.col("doc_id"), 10) != 0)
    counts = lm.count_tokens(train_docs).cache()
    for known in (20, 200_000):  # most words by the join, then all by the tasks
        scorer = lm.fit_scorer(train_docs, counts, classes=64, known_words=known, sample_docs=50)
        out = lm.score_texts(docs, scorer, counts).collect()
        assert len(out) == len(rows)
        for r in out:
            words = lm.tokens(rows[r["doc_id"]])
            base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in count for w in words), n)
            assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
    held = [r for r in out if folds[r["doc_id"]] == 0]
    # The base has one outcome for all words never met, the model one for each spelling: the same law of spellings goes to the base.
    spelt = sum(lm.spelled([w for w in lm.tokens(rows[r["doc_id"]]) if w not in count], scorer.letters).sum() for r in held)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + spelt
    assert all(r["score"] < 0 for r in out)


def test_scores_do_not_depend_on_how_rows_lie_and_letters_at_random_score_below_text(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    rng = np.random.default_rng(4)
    draw = lambda: bytes(rng.integers(97, 123, rng.integers(3, 10)).astype(np.uint8)).decode()
    junk = spark.createDataFrame([(-k, " ".join(draw() for _ in range(300))) for k in range(1, 6)], "doc_id long, text string")
    scores = []
    for parts in (1, 23):
        dealt = docs.repartition(parts)
        train_docs = dealt.where(lm.fold_share(F.col("doc_id"), 10) != 0)
        counts = lm.count_tokens(train_docs).cache()
        out = lm.score_texts(dealt.union(junk), lm.fit_scorer(train_docs, counts, classes=64), counts).collect()
        scores.append({r["doc_id"]: (r["score"], r["n_tokens"], r["base_score"]) for r in out})
    assert scores[0].keys() == scores[1].keys()
    for i, (score, *_) in scores[0].items():
        assert abs(score - scores[1][i][0]) <= 1e-6 * abs(score)
    lowest = min(s / n for i, (s, n, _) in scores[0].items() if i >= 0)
    assert all(s / n < lowest for i, (s, n, _) in scores[0].items() if i < 0)
    seen = [v for i, v in scores[0].items() if i >= 0 and zlib.crc32(str(i).encode()) % 10]
    assert sum(s for s, *_ in seen) > sum(b for *_, b in seen)


def test_letters_make_a_probability_of_strings():
    """Over all strings of two symbols, from a table of few words: what is left is longer strings."""
    place, spread, starts = lm.letters([b"ab", b"a7", "é".encode()])
    assert len(starts) == 3 and len(place) == len(spread) == 9
    assert np.allclose(np.bincount(lm._SYMBOL, 10.0**lm._SPREAD)[np.unique(lm._SYMBOL)], 1.0)


def test_scores_do_not_depend_on_the_way_of_a_word(spark):
    docs = table(spark, "documents").where("doc_id < 60")
    counts = lm.count_tokens(docs).cache()
    scorer = lm.fit_scorer(docs, counts, classes=32, sample_docs=20)
    few = lm.Scorer(scorer.net, {w: c for w, c in scorer.counts.items() if w in scorer.classes}, scorer.classes, scorer.total, scorer.distinct,
                    scorer.rare_total, scorer.rare_once, scorer.letters)
    a, b = ({r["doc_id"]: r["score"] for r in lm.score_texts(docs, s, counts).collect()} for s in (scorer, few))
    assert all(abs(a[i] - b[i]) < 1e-6 * abs(a[i]) for i in a)


def test_rare_words_are_told_apart(spark):
    """Words outside the own classes, known or only met in a join, have subclasses learned from their neighbours."""
    rng = np.random.default_rng(2)
    word = lambda end: "".join(chr(97 + i) for i in rng.integers(0, 26, 6)) + end
    texts = [" ".join(f"the {word('xu')} {word('zi')} ." for _ in range(60)) for _ in range(200)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    counts = lm.count_tokens(docs).cache()
    right, wrong = "the abcabcxu defdefzi . the ghighixu jkljklzi .", "the defdefzi abcabcxu . the jkljklzi ghighixu ."
    for known in (10, 200_000):
        scorer = lm.fit_scorer(docs, counts, classes=16, known_words=known)
        got = {r["doc_id"]: r["score"] for r in lm.score_texts(documents(spark, [(1, right, "", ""), (2, wrong, "", "")]), scorer, counts).collect()}
        assert got[1] > got[2] + 1


def test_all_documents_are_learned_from(spark):
    """Also those outside a sample of 2000, and what stands beyond 4000 characters."""
    from marshlight.llm.text import hash_sample

    ids = spark.range(2400).withColumnRenamed("id", "doc_id")
    first = {r["doc_id"] for r in hash_sample(ids, "doc_id", 2000).collect()}
    docs = documents(spark, [(i, "p r s q " * 5 if i in first else "p q s r " * 400, "", "") for i in range(2400)])
    net = lm.fit_scorer(docs, lm.count_tokens(docs), classes=16)
    k = [net.classes[w] for w in (b"s", b"p", b"q", b"r")]
    after = {w: net.net.log_probability(np.array([net.classes[b"r"]]), np.array([k[1]]), np.array([net.classes[w]]))[0] for w in (b"q", b"r")}
    assert after[b"q"] > after[b"r"] + 1


def test_more_words_more_classes():
    assert lm.class_count(1000) == lm.CLASSES < lm.class_count(4_000_000) < lm.class_count(40_000_000)


def test_scores_of_awkward_tables(spark):
    out = lm.held_out_scores(awkward(spark)).collect()
    assert len(out) == 13
    assert {r["n_tokens"] for r in out if r["doc_id"] in (1, 2, 3, 8)} == {1}
    assert sorted(r["n_tokens"] for r in out if r["doc_id"] == 5) == [7, 9, 9]
    assert lm.held_out_scores(empty(spark)).count() == 0


def test_toxicity_held_out(spark):
    out = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"), "doc_id")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] > 0.8 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.01 * n[0, 0]


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"trash": 3.0, "idiot": 3.0}, model=(1.0, 1.0, 1.0, -2.0))
    assert toxicity.fold("1D10Т, trаsh!") == " idiot  trashi "
    assert lexicon.score("you 1d10t") > 0.5 > lexicon.score("a calm text")
    assert lexicon.score("put it in the trash can") < 0.5 < lexicon.score("you are trash, can you see")
    assert lexicon.features("idiot " + "word " * 1000)[2] < lexicon.features("idiot word")[2]
    assert lexicon.features("amidiot")[0] == 0  # only at the beginning of a word
    assert lexicon.features("the trash \n  can")[0] == 0 and lexicon.features("you trash, can")[0] == 1
    assert lexicon.features("idiot" + " " * 200 + "word") == lexicon.features("idiot word")
    assert lexicon.pairs("so you  trashy, idiot go") == {"you trashy ", "idiot go "}


def test_exceptions_are_learned_from_clean_documents(spark):
    """A word of toxic documents that is harmless in one phrase: documents with the phrase alone are clean."""
    rows = [(i, f"you vermin number {i} go", 1) for i in range(60)] + [(100 + i, f"a vermin trap number {i} stands here", 0) for i in range(8)]
    rows += [(200 + i, f"calm words number {i}", 0) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit_toxicity(documents(spark, [(i, t, "en", "a") for i, t, _ in rows]), labels)
    assert "vermin trap " in lexicon.exceptions
    assert lexicon.score("our vermin  trap works") < 0.5 < lexicon.score("your vermin trappers are vermin")


def test_copies_are_one_witness():
    counts = {"abcd": (40, 0), "abcde": (40, 0), "abcdef": (10, 0), "wxyz": (40, 30), "rare": (3, 0)}
    assert set(toxicity.choose_stems(counts, 50, 300)) == {"abcde"}


def test_texts_that_begin_alike_are_witnesses_each(spark):
    """Only equal texts with one label are one witness; a clean document with a smaller id hides no toxic one."""
    lead = "This one header stands before every text of the source. "
    texts = [lead + (f"vermin{chr(97 + i % 26)} number {i}" if i >= 40 else f"calm words number {i}") for i in range(80)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, int(i >= 40)) for i in range(80)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit_toxicity(docs, labels)
    assert any(s.startswith("verm") for s in lexicon.weights)
    assert lexicon.score(lead + "verminx again") > 0.5 > lexicon.score(lead + "calm words")


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_planted_toxic_documents_are_found_at_each_scale(spark, scale):
    """In the labels' toxic documents a word and a short word stand that no other text holds."""
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{scale}/labels.parquet")
    marked = labels.where("toxic = 1").select("doc_id", F.lit(1).alias("bad"))
    for word in ("vermilord", "zyx"):
        planted = docs.join(marked, "doc_id", "left").withColumn("text", F.when(F.col("bad") == 1, F.concat("text", F.lit(f" {word} {word} "))).otherwise(F.col("text"))).drop("bad")
        lexicon = toxicity.fit_toxicity(planted, labels)
        assert any(f"{word} ".startswith(s) for s in lexicon.weights)
        assert lexicon.score(f"so {word} says") > 0.5 > lexicon.score("so they say")


def test_evidence_does_not_depend_on_class_sizes_alike():
    counts = {"abcd": (60, 4)}  # a rate of 0.6 in toxic documents, whatever their number
    assert set(toxicity.choose_stems(counts, 100, 400)) == set(toxicity.choose_stems({"abcd": (6, 1)}, 10, 400)) == {"abcd"}
    assert toxicity.choose_stems({"abcd": (2, 0)}, 4000, 4000) == {}


def test_toxicity_of_awkward_tables(spark):
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (6, 0, 1), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit_toxicity(awkward(spark), labels)
    out = toxicity.score_toxicity(awkward(spark), lexicon).collect()
    assert len(out) == 13 and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in out)
    assert toxicity.fit_toxicity(awkward(spark), labels.limit(0)).weights == {}
    assert toxicity.score_toxicity(empty(spark), lexicon).count() == 0
    assert toxicity.keep_clean(awkward(spark), lexicon).schema == awkward(spark).schema


@pytest.mark.parametrize("k", [1, 10])
def test_top_k_against_brute_force(spark, k):
    rng = np.random.default_rng(k)
    v = (rng.standard_normal((400, 12)) / 3).astype(np.float32)
    v[50:90] = v[3]  # ties
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k, block_rows=64, query_rows=8)
    whole = np.floor(v.astype(np.float64) * 1024).astype(np.int64)
    want = set()
    for q in range(0, 400, 20):
        scores = whole @ whole[q]
        best = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:k]
        want |= {(q, r, i, int(scores[i])) for r, i in enumerate(best, 1)}
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want


def test_reading_stops_early_and_stays_exact():
    rng = np.random.default_rng(5)
    v = rng.integers(-50, 50, (4096, 4))
    v[7] = 5000
    lists = topk.SortedLists(np.arange(4096), v)
    ids, scores = lists.best(np.array([1, 2, 3, 4]), -1, 1)
    assert ids.tolist() == [7] and scores.tolist() == [50_000]


def test_top_k_of_awkward_tables(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [None, 1.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (None, [1.0, 1.0]),
            (5, [0.5, -0.001]), (6, [1.0]), (100, []), (7, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect()}
    assert got == {(0, 1, 5, 512 * 1024 - 2 * 2048), (0, 2, 7, 0)}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
