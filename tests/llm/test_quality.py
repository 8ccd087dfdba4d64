import random
import re

from shopflow.llm import quality

from .helpers import DOCS, awkward, nothing


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def prose(rng, n):
    return " ".join(rng.choice("the of and water house light mountain river early story paper garden people".split()) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


def test_base_statistics(spark):
    rng = random.Random(4)
    texts = ["a b c d e f g h " * 3, "x " * 40, "line one\nline one\n\nline two\r\nline one", "a b c d e f g h i a b c d e f g h\x0bz", "#*$ %&|<> é日 #", "\n\n", "  lead"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    docs = awkward(spark, extra=False).union(spark.createDataFrame([(100 + i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS))
    want = sorted((str(r.doc_id), *brute(r.text)) for r in docs.collect())
    got = quality.judge(docs).collect()
    assert sorted((str(r.doc_id), *[r[c] for c in quality.BASE]) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_texts_stay(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([25, 60, 200, 1500])), "en", "hot" if i % 3 else f"s{i % 4}", 0) for i in range(600)]
    bad = {1000 + i: t for i, t in enumerate([
        " ".join(w + "###" for w in prose(rng, 120).split()), " | ".join(prose(rng, 150).split()), " ".join("x" * 40 + str(i) for i in range(60)),
        " ".join("a" for _ in range(25)) + " " + prose(rng, 200).replace("e", "$"),
    ])}
    rows += [(i, t, "en", "hot", 0) for i, t in bad.items()]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].kept for i in range(600))
    assert not any(got[i].kept for i in bad)
    kept = quality.keep_clean(spark.createDataFrame(rows, DOCS))
    assert kept.columns == DOCS.names and {r.doc_id for r in kept.collect()} == set(range(600))


def test_estimate_withstands_a_quarter_of_junk(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 100), "en", "s", 0) for i in range(300)] + [(300 + i, " ".join(w + "%%" for w in prose(rng, 100).split()), "en", "s", 0) for i in range(70)]
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(rows, DOCS)).where("kept").collect()}
    assert kept == set(range(300))


def test_constants():
    assert abs(quality.chi2_point(0.95, 2) - 9.4877) < 1e-3  # four degrees of freedom
    assert 1.4 < quality.consistency(0.75) < 1.6


def test_edges(spark):
    assert quality.judge(nothing(spark)).count() == 0
    assert quality.keep_clean(nothing(spark)).count() == 0
    docs = awkward(spark)
    kept = quality.keep_clean(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "2", "6", "9", "None"]


def test_no_python_in_the_plan(spark):
    plan = quality.judge(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_each_statistic_can_reject_alone(spark):
    """One planted outlier per coordinate, odd in that coordinate only."""
    rng = random.Random(8)
    rows = [(i, "\n".join(prose(rng, 10) for _ in range(rng.choice([3, 12, 60]))), "en", "s", 0) for i in range(300)]
    passage = prose(rng, 30)
    bad = {
        1000: " ".join("x" * 40 + str(i) for i in range(60)), 1001: " ".join(w + "###" for w in prose(rng, 120).split()),
        1002: "\n".join(f"{prose(rng, 6)}\nthe\nof\nand" for _ in range(20)), 1003: f"{prose(rng, 70)} {passage} {prose(rng, 70)} {passage}",
    }
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows + [(i, t, "en", "s", 0) for i, t in bad.items()], DOCS)).collect()}
    assert all(got[i].kept for i in range(300))
    assert got[1002].n_repeat_words == 0 < got[1002].n_dup_lines and got[1003].n_dup_lines == 0 < got[1003].n_repeat_words
    assert not any(got[i].base_failed or got[i].kept for i in bad)


def test_small_groups_are_judged_by_all_rows(spark):
    """60 texts of a rare language beside 300 of another, and 60 texts alone."""
    rng = random.Random(9)
    odd = " ".join(w + "###" for w in prose(rng, 120).split())
    rare = [(1000 + i, prose(rng, 100), "xx", "s", 0) for i in range(60)] + [(2000, odd, "xx", "s", 0)]
    for rows in (rare + [(i, prose(rng, 100), "en", "s", 0) for i in range(300)], rare):
        kept = {r.doc_id for r in quality.judge(spark.createDataFrame(rows, DOCS)).where("kept").collect()}
        assert kept == {r[0] for r in rows} - {2000}
