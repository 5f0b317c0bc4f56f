import random
import re
from collections import defaultdict

from webloom.llm import repeats
from webloom.session import materialize


def fold(line):
    return re.sub("[0-9]+", "0", re.sub("^ +| +$", "", re.sub("[ \t]+", " ", line)).lower())


def fixture():
    rnd = random.Random(5)
    pool = ["Share  this", "© 2020 Us", "Menu\t| Home", "by 12", "BY 7 ", "unique"]
    rows = []
    for i in range(150):
        site = rnd.choice(["hot"] * 4 + ["a", "b", "c"])
        lines = [rnd.choice(pool) if rnd.random() < 0.4 else f"line {rnd.choice('abcdefghijklmnop') * rnd.randint(1, 9)}" for _ in range(rnd.randint(0, 8))]
        rows.append((i, rnd.randint(0, 90), site, "\n".join(lines)))
    urls = {}
    rows = [(i, u, urls.setdefault(u, s), t) for i, u, s, t in rows]
    return rows + [(900, 901, "a", None), (901, 902, None, "Share this"), (902, None, "a", "Share this"), (903, 903, "a", ""), (904, 904, "a", "\n \t\n")]


def plain(rows):
    docs, sites = defaultdict(set), defaultdict(set)
    for _, u, s, t in rows:
        if t is None or s is None or u is None:
            continue
        sites[s].add(u)
        for line in t.split("\n"):
            if fold(line):
                docs[s, fold(line)].add(u)
    good = {k for k, v in docs.items() if len(v) >= 4 and 10 * len(v) >= len(sites[k[0]])}
    return sorted((i, n) for i, u, s, t in rows if t is not None and u is not None for n, line in enumerate(t.split("\n")) if (s, fold(line)) in good)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url_id long, domain string, content string")
    from pyspark.sql import functions as F

    return df.withColumns({"lines": F.lit(1), "key": F.lit("clash"), "support": F.lit(0)})


def test_against_a_plain_count(spark):
    rows = fixture()
    found = repeats.find_repeated_lines(frame(spark, rows), "domain", "url_id", "page_id")
    want = plain(rows)
    assert want and sorted((r.page_id, r.line_no) for r in found.collect()) == want
    assert repeats.find_repeated_lines(frame(spark, []), "domain", "url_id", "page_id").count() == 0


def test_removal(spark):
    rows = fixture()
    df = frame(spark, rows)
    gone = set(plain(rows))
    kept = {r.page_id: r.content for r in repeats.remove_repeated_lines(df, repeats.find_repeated_lines(df, "domain", "url_id", "page_id"), "page_id").collect()}
    for i, _, _, t in rows:
        if t is None:
            assert kept[i] is None
        else:
            want = "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
            assert kept[i] == want


def test_sequences_against_plain_growth(spark):
    rows = [(i, i, "s", "\n".join(["head", f"x{'y' * i}", "share", "print", "legal"][: 5 - i % 2])) for i in range(8)] + [(20 + i, 20 + i, "s", "share\nother" + "z" * i + "\nprint") for i in range(4)]
    found = repeats.frequent_sequences(frame(spark, rows), "domain", "url_id", "page_id", min_documents=4, share=0.3).collect()
    # frequent lines: head 8, share 12, print 12, legal 4; neighbours once the infrequent lines are gone
    assert sorted((len(r.pattern), r.support) for r in found) == sorted([(1, 8), (1, 12), (1, 12), (1, 4), (2, 8), (2, 12), (2, 4), (3, 8), (3, 4), (4, 4)])


def test_sequences_reach_over_rotating_lines(spark):
    rows = [(i, i, "s", f"menu\nnotice {'abc'[i % 3]}\nfooter\nlegal") for i in range(12)] + [(50, 50, "s", "footer"), (51, 50, "s", "menu")]
    found = repeats.frequent_sequences(frame(spark, rows), "domain", "url_id", "page_id", min_documents=4, share=0.2).collect()
    # menu-footer skips another notice each time and stays; menu-legal always skips the footer and goes;
    # the rows of one document make no sequence
    sizes = {(len(r.pattern), r.support) for r in found}
    assert sizes >= {(2, 12), (3, 12), (4, 4)} and max(n for n, _ in sizes) == 4


def test_growth_against_plain_growth(spark):
    rnd = random.Random(11)
    rows = [(i, i, "s", "\n".join(rnd.choice("abc") * 3 for _ in range(rnd.randint(3, 8)))) for i in range(30)]
    found = repeats.frequent_sequences(frame(spark, rows), "domain", "url_id", "page_id", min_documents=4, share=0.2).collect()
    docs = [t.split("\n") for *_, t in rows]
    lines = {x for d in docs for x in d if sum(x in e for e in docs) >= 6}
    docs = [[x for x in d if x in lines] for d in docs]
    level = {(x,): [(n, i) for n, d in enumerate(docs) for i, y in enumerate(d) if y == x] for x in lines}
    want = [(1, len({n for n, _ in ends})) for ends in level.values()]
    while level:
        grown = defaultdict(list)
        for pattern, ends in level.items():
            for n, i in set(ends):
                for j in range(i + 1, min(i + 4, len(docs[n]))):
                    grown[*pattern, docs[n][j]].append((n, j, frozenset(docs[n][i + 1 : j])))
        level = {}
        for pattern, places in grown.items():
            support = len({n for n, *_ in places})
            if support >= 6 and not frozenset.intersection(*(s for *_, s in places)):
                level[pattern] = [(n, j) for n, j, _ in places]
                want.append((len(pattern), support))
    assert max(want)[0] > 2
    assert sorted((len(r.pattern), r.support) for r in found) == sorted(want)


def test_marking_sends_nothing_through_the_driver(spark):
    sequences = materialize(repeats.line_sequences(frame(spark, fixture()), "domain", "url_id", "page_id", "content"), "lines")
    frequent = materialize(repeats.frequent_lines(sequences, repeats.support_needed(sequences, 4, 0.1)), "frequent")
    found = repeats.mark(sequences, frequent)
    assert sorted((r.key, r.no) for r in found.collect()) == plain(fixture())
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
