"""URL filters, decontamination, line dedup, mixing: hand-made and awkward cases."""

import collections

import pytest

from marshlight.llm import decontaminate, line_dedup, mixing, url_filter
from tests.llm.frames import awkward, documents, empty

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow")]


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    table = url_filter.rule_table(spark, rules)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, table).collect()}


def test_url_rules(spark):
    got = judged(spark, [
        "https://A.Example.ORG/es/x?q#f", "http://example.org/en/1234.html", "http://example.org/en/2", "http://notexample.org/es/", None,
        "example.org/es/", "http://example.org", "http://example.org?x=/es/", "http://b.com/fr/", "ftp://x://example.org/es/", ""])
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/1234.html", "example.org/en/1", "block")
    assert got[2] == ("example.org", "/en/2", "org/", "allow")
    assert got[3] == ("notexample.org", "/es/", "org/", "allow")
    assert got[4] == got[5] == got[10] == ("", "", None, "allow")
    assert got[6] == ("example.org", "", None, "allow") and got[7][2] is None
    assert got[8][2:] == ("com/fr/", "allow")
    assert got[9] == ("x:", "//example.org/es/", None, "allow")


def test_url_ties_nulls_and_empty_tables(spark):
    assert judged(spark, ["http://a.bc/x/"], [("a.bc", "/", "allow"), ("bc", "/x/", "block")])[0][3] == "block"  # as long: block wins
    assert judged(spark, ["http://a.bc/x/"], [(None, "/", "block")])[0] == ("a.bc", "/x/", None, "allow")
    assert judged(spark, [], RULES) == {}
    assert judged(spark, ["http://org/" + "x" * 50_000] * 2)[1][2] == "org/"


def lines_kept(spark, rows, **options):
    out = line_dedup.dedup_lines(documents(spark, [(i, t, "en", "a") for i, t in rows]), **options)
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"], [tuple(x) for x in r["runs"]]) for r in out.collect()}


def test_common_lines_go(spark):
    rows = [(i, f"own {i}\n  Common LINE\t\n\nlast {i}") for i in range(12)] + [(99, "common line\ncommon line\nx\ncommon line")]
    got = lines_kept(spark, rows)
    assert got[3] == ("own 3\n\nlast 3", 4, 1, [(1, 1)])
    assert got[99] == ("x", 4, 3, [(0, 2), (3, 1)])
    first = lines_kept(spark, rows, keep_first=True)
    assert first[0][2] == 0 and first[1][2] == 1


def test_a_line_counts_documents_not_lines(spark):
    assert lines_kept(spark, [(1, "a\n" * 30)])[1] == ("a\n" * 30, 31, 0, [])
    assert lines_kept(spark, [(i, "É") for i in range(10)])[0][0] == ""
    assert lines_kept(spark, [(i, "É" if i % 2 else "é") for i in range(10)])[0][2] == 0  # only A-Z are folded


def test_lines_of_awkward_tables(spark):
    df = awkward(spark)
    out = line_dedup.dedup_lines(df, min_docs=2)
    assert out.count() == df.count()
    assert out.where("doc_id = 1").first()["n_lines"] == 1 and not out.where("doc_id = 1").first()["was_text"]
    assert [r["n_dropped"] for r in out.where("doc_id = 5").collect()] == [0, 0, 0]
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def brute_mix(rows, block=256):
    import hashlib

    sizes = {k: len(t.split()) if t else 0 for k, (_, t, _, _) in enumerate(rows)}
    by = collections.defaultdict(list)
    for k, (i, _, _, s) in enumerate(rows):
        by[s].append((hashlib.md5(str("" if i is None else i).encode()).hexdigest(), k))
    names = sorted([s for s in by if s is not None]) + ([None] if None in by else [])
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    size = {s: sum(sizes[k] for _, k in by[s]) for s in names}
    goal, full = 1.5 * sum(size.values()), set()
    while True:
        level = (goal - sum(2 * size[s] for s in full)) / (sum(weight[s] for s in names if s not in full) or 1)
        more = {s for s in names if s not in full and 2 * size[s] < level * weight[s]}
        if not more:
            break
        full |= more
    return sizes, size, {s: 2.0 * size[s] if s in full else level * weight[s] for s in names}


@pytest.mark.parametrize("block", [1, 7, 256])
def test_mix_meets_targets(spark, block):
    rows = [(i, " ".join(["w"] * (i * 37 % 91)), "en", [None, "b", "a", "c", "é"][i % 5 if i % 3 else 2]) for i in range(300)]
    sizes, size, target = brute_mix(rows)
    out = mixing.mix_sources(documents(spark, rows), block=block).collect()
    assert len(out) == 300 and {r["doc_id"]: r["size"] for r in out} == {i: sizes[i] for i in range(300)}
    taken = collections.Counter()
    for r in out:
        assert r["taken"] <= 2 * r["size"] and abs(r["target"] - target[rows[r["doc_id"]][3]]) < 1e-6
        taken[rows[r["doc_id"]][3]] += r["taken"]
    for s, t in target.items():
        assert taken[s] == round(t) or abs(taken[s] - t) <= 1


def test_schedule_spreads_every_source(spark):
    rows = [(i, " ".join(["w"] * 40), "en", "abc"[i % 3]) for i in range(300)]
    targets = mixing.source_targets(documents(spark, rows).selectExpr("source", "40L AS size"))
    slots = mixing.schedule(targets, 16).orderBy("k").collect()
    share = {r["source"]: r["target"] / 18_000 for r in targets.collect()}
    seen = collections.Counter()
    for n, r in enumerate(slots[:600], 1):
        assert r["rank"] == seen[r["source"]]  # ranks count a source's slots in order
        seen[r["source"]] += 1
        for s, p in share.items():
            assert abs(seen[s] - p * n) < 12


def test_mix_of_awkward_tables(spark):
    df = awkward(spark)
    out = mixing.mix_sources(df)
    assert out.count() == df.count() and out.where("size = 0 AND taken > 0").count() == 0
    assert mixing.mix_sources(empty(spark)).count() == 0
    blank = mixing.mix_sources(documents(spark, [(1, None, None, "a"), (2, " ", None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2


ITEM = "in the old town Anna paid 35 eur for fuel and later she paid again 35 eur for food before Anna went home to sleep"


def passages(spark, texts, items=((7, ITEM),)):
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.find_passages(docs, bench).collect()}


def test_passages_are_found_with_new_values(spark):
    filler = " ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    other = ITEM.replace("Anna", "Maria").replace("eur", "usd").replace("35", "20")
    mixed = ITEM.replace("35", "75", 1)  # the other 35 stays, in windows of its own
    got = passages(spark, [ITEM, f"{filler} {ITEM} {filler}", f"{filler}\n{other}", f"{filler} {mixed}", filler, ITEM[:60], None, ""])
    assert {d for d, _ in got} == {0, 1, 2, 3}


def test_one_value_of_the_item_stands_for_one_of_the_document(spark):
    item = "a shop sells 3 pens for each of 5 pupils and then adds 3 more pens to a box with 5 free ones"
    texts = [item.replace("3", a).replace("5", b) for a, b in (("7", "8"), ("4", "4"), ("5", "3"))]
    texts.append(item.replace("5", "6", 1))
    dense = "so 3 and 3 make twice 3 or 3 plus 3 with 3 more than 3 from 3 less"
    texts += [dense, dense.replace("3", "9")]
    for n in range(8):  # every 3 becomes another value: all windows contradict themselves
        dense = dense.replace("3", str(50 + n), 1)
    texts.append(dense)
    got = passages(spark, texts, [(1, item), (2, texts[4])])
    assert got == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 2), (5, 2)}


def brute_passages(texts, items, share=0.5):
    import re

    def tokens(t):
        return re.findall(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+", t or "")

    def slot(t):
        return "#" if t[0].isdigit() else "@" if t != t.lower() else "%" if t in decontaminate.UNITS else None

    def template(ts):
        return [slot(t) or t for t in ts]

    out = set()
    for d, text in enumerate(texts):
        for i, it in items:
            doc, own = tokens(text), tokens(it)
            w = min(8, len(own))
            found, strong = set(), set()
            for p in range(len(own) - w + 1 if own else 0):
                a = own[p:p + w]
                if w >= 5 and sum(not slot(t) for t in a) * 2 > w:
                    strong.add(p)
                for q in range(len(doc) - w + 1):
                    b = doc[q:q + w]
                    if (p in strong and template(a) == template(b) and len(set(zip(a, b))) == len(set(a))) or (
                            a == b and (w > 2 or len(doc) == w)):
                        found.add(p)
            n = max(0, len(own) - w + 1)
            if found and (len(found) >= share * n or (strong and len(found & strong) >= share * len(strong))):
                out.add((d, i))
    return out


def test_passages_against_brute_force(spark):
    import random

    r = random.Random(5)
    words = ["a", "b", "c", "d", "e", "f", "km", "Anna", "Bo", "3", "4", "5"]
    items = [(i, " ".join(r.choices(words, weights=[4] * 6 + [1] * 6 if i % 2 else None, k=r.choice([1, 2, 3, 4, 5, 6, 9, 14, 20])))) for i in range(40)]
    texts = [None, "", "a"]
    for _, it in items:
        for _ in range(3):
            part = it.split()
            part = [r.choice(words) if r.random() < 0.1 else {"3": "7", "Anna": "Carla"}.get(t, t) if r.random() < 0.5 else t for t in part]
            texts.append(" ".join(r.choices(words, k=r.randrange(4)) + part[r.randrange(2) * r.randrange(len(part)):] + r.choices(words, k=r.randrange(4))))
        texts.append(it)
    assert passages(spark, texts, items) == brute_passages(texts, items)


def test_a_window_that_all_items_share_brings_no_pairs(spark):
    shared = "which of the following is the right answer to the question below"
    items = [(i, f"{shared} " + " ".join(f"w{chr(97 + i)}{chr(97 + k)}" for k in range(20))) for i in range(20)]
    assert passages(spark, [shared, items[3][1], f"x {shared} y"], items) == {(1, 3)}
    bench = spark.createDataFrame([(i, j, True, 7 if j < 5 else 1000 + 100 * i + j) for i in range(20) for j in range(12)],
                                  "item long, pos int, strong boolean, hash long")
    assert decontaminate.rare_first(bench, 0.5).where("rare").selectExpr("min(pos)", "count(*)").first()[:] == (5, 140)


def test_every_place_is_looked_at(spark):
    lead = [" ".join(["vor"] * k) + " " + ITEM for k in range(9)]
    assert {d for d, _ in passages(spark, lead)} == set(range(9))


def test_short_items_and_items_of_placeholders(spark):
    capital = "The Capital Of France Is Paris And The Capital Of Spain Is Madrid"
    items = [(1, "only four words here"), (2, "exactly five words are here"), (3, None), (4, ""), (5, "One Two Three Four Five Six"),
             (6, capital), (7, "What is 12 plus 30"), (8, "Solve 3 x 5"), (9, "Paris"), (10, "Why not")]
    texts = ["so only four words here", "pad pad exactly five words are here pad", "One Two Three Four Five Six", f"see: {capital}.",
             "x What is 12 plus 30?", "y Solve 3 x 5", "Paris!", "in Paris", "Why not", "Why not so", "Solve 3 x 6", "Six Five Four Three Two One",
             "What is 13 plus 31", capital.replace("Paris", "Rome").replace("France", "Italy")]
    assert passages(spark, texts, items) == {(0, 1), (1, 2), (2, 5), (3, 6), (4, 7), (5, 8), (6, 9), (8, 10)}


def test_passages_in_awkward_tables(spark):
    bench = spark.createDataFrame([(1, "the same line the same line and more"), (1, "the same line the same line and more"), (None, ITEM)], "item_id long, text string")
    got = decontaminate.find_passages(awkward(spark), bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(5, 1)]
    assert decontaminate.find_passages(empty(spark), bench).count() == 0
    assert decontaminate.find_passages(awkward(spark), bench.limit(0)).count() == 0
