"""Words by a dictionary."""

import random

import pytest

from rillmart.operators import segment, stats


def words(spark, texts, dictionary, mode):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = segment.words_of(df, "t", spark.createDataFrame([(w,) for w in dictionary], "word string"), mode).collect()
    out = {}
    for r in rows:
        assert r.word not in out.setdefault(r.t, {})
        out[r.t][r.word] = r.times
    return out


def test_han_words_overlap_or_the_longest_are_taken(spark):
    text, known = "大数据项目之Flink实时数仓", ["数据", "大数据", "项目", "实时", "数仓", "时数", "flink"]
    assert words(spark, [text], known, "all")[text] == {
        "大数据": 1, "数据": 1, "项目": 1, "之": 1, "flink": 1, "实时": 1, "时数": 1, "数仓": 1}
    assert words(spark, [text], known, "longest")[text] == {"大数据": 1, "项目": 1, "之": 1, "flink": 1, "实时": 1, "数仓": 1}


def test_words_end_where_units_end(spark):
    got = words(spark, ["party  Phone\tCASE, phone. case 数 据"], ["art", "phone case", "数据"], "all")
    assert list(got.values()) == [{"party": 1, "phone case": 1, "phone": 1, "case": 1, "数": 1, "据": 1}]


def test_empty_texts_and_dictionaries(spark):
    assert words(spark, [None, "", " ,. ", "a b a"], [None, ""], "all") == {"a b a": {"a": 2, "b": 1}}
    assert words(spark, [], ["a"], "longest") == {} and words(spark, ["A", "A"], ["a", "A", "a "], "longest") == {"A": {"a": 1}}
    with pytest.raises(ValueError):
        words(spark, ["a"], ["a"], "shortest")


def brute(text, known, mode):
    units, out, i = text.split(" "), {}, 0
    spans = [(s, e) for s in range(len(units)) for e in range(s + 1, len(units) + 1) if " ".join(units[s:e]) in known]
    if mode == "longest":
        taken = []
        while i < len(units):
            ends = [e for s, e in spans if s == i]
            taken += [(i, max(ends))] if ends else []
            i = max(ends) if ends else i + 1
        spans = taken
    inside = {p for s, e in spans for p in range(s, e)}
    for w in [" ".join(units[s:e]) for s, e in spans] + [u for p, u in enumerate(units) if p not in inside]:
        out[w] = out.get(w, 0) + 1
    return out


@pytest.mark.parametrize("mode", segment.MODES)
def test_against_brute_force(spark, mode):
    r = random.Random(5)
    texts = sorted({" ".join(r.choices("abc", k=r.randint(1, 40))) for _ in range(120)})
    known = sorted({" ".join(r.choices("abc", k=r.randint(1, 5))) for _ in range(40)} - {"b"})
    assert words(spark, texts, known, mode) == {t: brute(t, set(known), mode) for t in texts}


def test_a_long_text_is_read_whole(spark):
    text = "x " + "a b c " * 4_000 + "y"
    got = words(spark, [text], ["a b", "b c a", "y"], "longest")[text]
    assert got == {"x": 1, "a b": 4_000, "c": 4_000, "y": 1}


def test_a_text_everybody_searches_for(spark):
    search = spark.range(3000).selectExpr("if(id % 3 = 0, 'red phone', 'phone case') as keywords", "timestamp_millis(id) as rt")
    known = spark.createDataFrame([("red phone",), ("phone",)], "word string")
    got = {r.keyword: (r.ct, r.ts) for r in stats.keyword_stats_by_dictionary(search, known, "longest").collect()}
    assert got == {"red phone": (1000, 0), "phone": (2000, 1), "case": (2000, 1)}
