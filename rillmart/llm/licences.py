"""Licence scan: TF-IDF cosine of sentences and whole files to templates, then the licence of the nearest directory above.

Every sentence or line of every file is compared with the templates, sentences over
several lines too, also within comments.  Only sentences that hold a telling term can
reach the threshold: the other terms of a template are so light that together they stay
below it.  Files are compared with whole licence texts, those that hold enough of one's
terms.  A file that is such a text, or made up of licence sentences to a good part,
covers its directory; files without a licence of their own inherit from the nearest
directory above them that has one.  All of it is DataFrame functions and joins.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored
from .licence_texts import full_texts, templates

LEAST_COSINE = 0.7
#: A file with this share of its words in matching sentences is a licence file.
FILE_SHARE = 0.3
#: A file is a licence's whole text from this cosine on; counts go in by their logarithm.
WHOLE_COSINE = 0.85
_PARTS = r"[^\p{L}\p{N}]+"
_SENTENCES = r"\n|(?<=[.!?;:])\s+"
#: Line starts with the marks of comments, and where sentences end that go on over lines or semicolons.
_MARKS = r"(?m)^[ \t]*(?:(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--|-->|(?:dnl|rem|REM)\b)[ \t]*)?"
_WRAPPED = r"\n[ \t\r]*\n\s*|(?<=[.!?])\s+"


def terms(sentence: str) -> list[str]:
    return [x for x in re.split(r"[\W_]+", sentence.lower()) if x]


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _PARTS), "")


def weigh(df: dict[str, int], files: int, least: float, texts: list[tuple[str, str]]) -> dict:
    """Vocabulary, inverse document frequencies, unit template vectors, and the telling terms."""
    vocabulary = sorted({t for _, s in texts for t in terms(s)})
    idf = [math.log((1 + files) / (1 + df.get(t, 0))) + 1 for t in vocabulary]
    place = {t: i for i, t in enumerate(vocabulary)}
    vectors, telling = [], set()
    for licence, s in texts:
        counts = Counter(terms(s))
        raw = {place[t]: n * idf[place[t]] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vector = sorted((i, x / norm) for i, x in raw.items())
        vectors.append({"licence": licence, "i": [i for i, _ in vector], "w": [w for _, w in vector]})
        # The lightest terms, as long as all of them together stay below the threshold, can't carry a match.
        mass = 0.0
        for i, w in sorted(vector, key=lambda x: (x[1], x[0])):
            mass += w * w
            if mass >= (least * 0.999) ** 2:
                telling.add(vocabulary[i])
    return {"terms": vocabulary, "idf": idf, "templates": vectors, "telling": sorted(telling)}


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def document_frequencies(files: DataFrame, texts: list[tuple[str, str]]) -> tuple[dict[str, int], int]:
    """In how many files each template term occurs, and the number of files; the terms bound what comes back."""
    vocabulary = sorted({t for _, s in texts for t in terms(s)})
    held = F.array_intersect(_literal(vocabulary, "array<string>"), _tokens(F.coalesce(F.col("text"), F.lit(""))))
    # The empty term stands for the file itself.
    rows = files.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("term")).groupBy("term").count().collect()
    df = {r["term"]: r["count"] for r in rows}
    return df, df.pop("", 0)


def best_matches(text: Column, model: dict, least: float) -> Column:
    """A struct of words, matched_words and best (score, licence) over all sentences; best is NULL below ``least``."""
    vocabulary, idf = _literal(model["terms"], "array<string>"), _literal(model["idf"], "array<double>")
    vectors = _literal(model["templates"], "array<struct<licence:string,i:array<int>,w:array<double>>>")
    telling = _literal(model["telling"], "array<string>")

    def add(a: Column, x: Column) -> Column:
        return a + x

    def match(tokens: Column) -> Column:
        counts = F.transform(vocabulary, lambda t: F.size(F.filter(tokens, lambda x: x == t)).cast("double"))

        def compare(c: Column) -> Column:
            foreign = F.size(tokens) - F.aggregate(c, F.lit(0.0), add)
            weights = F.zip_with(c, idf, lambda n, i: n * i)

            def score(v: Column) -> Column:
                norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), add) + foreign)
                scores = F.transform(vectors, lambda t: F.struct(
                    F.round(F.aggregate(F.zip_with(t["i"], t["w"], lambda i, w: F.get(v, i) * w), F.lit(0.0), add) / norm, 9).alias("score"),
                    t["licence"].alias("licence")))
                # Of equal scores the licence whose name comes first.
                best = F.aggregate(scores, F.struct(F.lit(-1.0).alias("score"), F.lit("").alias("licence")),
                                   lambda a, x: F.when(x["score"] > a["score"], x).otherwise(a))
                return let(best, lambda b: F.struct(b["score"].alias("score"), b["licence"].alias("licence"), F.size(tokens).alias("words")))

            return let(weights, score)

        return let(counts, compare)

    def matches(units: Column) -> Column:
        return F.filter(F.transform(F.filter(units, lambda w: F.arrays_overlap(w, telling)), match), lambda m: m["score"] >= least)

    def matched(found: Column) -> Column:
        return F.aggregate(found, F.lit(0), lambda a, m: a + m["words"])

    whole = F.coalesce(text, F.lit(""))
    wrapped = F.filter(F.split(F.regexp_replace(whole, _MARKS, ""), _WRAPPED), lambda x: x.rlike(r"\n|;\s"))

    def of(units: Column) -> Column:
        found = F.struct(matches(units).alias("lines"), matches(F.transform(wrapped, _tokens)).alias("wrapped"))
        return let(found, lambda f: F.struct(
            F.aggregate(units, F.lit(0), lambda a, w: a + F.size(w)).alias("words"),
            # A line and the sentence it lies in may match both, so the words of only one kind count.
            F.greatest(matched(f["lines"]), matched(f["wrapped"])).alias("matched_words"),
            F.aggregate(F.concat(f["lines"], f["wrapped"]), F.lit(None).cast("struct<score:double,licence:string>"), lambda a, m: F.when(
                a.isNull() | (m["score"] > a["score"]), F.struct(m["score"].alias("score"), m["licence"].alias("licence"))).otherwise(a)).alias("best")))

    return let(F.transform(F.split(whole, _SENTENCES), _tokens), of)


def weigh_whole(df: dict[str, int], files: int, least: float, texts: list[tuple[str, str]]) -> dict:
    """Vocabulary, idf, dense unit vectors of whole texts, and how many of its terms a file at the threshold holds at least."""
    counts = [(licence, Counter(terms(s))) for licence, s in texts]
    vocabulary = sorted({t for _, c in counts for t in c})
    idf = [math.log((1 + files) / (1 + df.get(t, 0))) + 1 for t in vocabulary]
    vectors = []
    for licence, c in counts:
        raw = [(1 + math.log(c[t])) * i if c[t] else 0.0 for t, i in zip(vocabulary, idf, strict=True)]
        norm = math.sqrt(sum(x * x for x in raw))
        unit = [round(x / norm, 9) for x in raw]
        # A cosine is at most the length of the part of the vector whose terms the file holds.
        needed, mass = 0, 0.0
        for w in sorted(unit, reverse=True):
            if mass >= (least * 0.999) ** 2:
                break
            mass, needed = mass + w * w, needed + 1
        vectors.append({"licence": licence, "terms": sorted(c), "w": unit, "needed": needed})
    return {"terms": vocabulary, "idf": idf, "texts": vectors, "needed": min(v["needed"] for v in vectors)}


def whole_match(text: Column, model: dict, least: float) -> Column:
    """The (score, licence) of the whole licence text that a file is; NULL below ``least``."""
    vocabulary, idf = _literal(model["terms"], "array<string>"), _literal(model["idf"], "array<double>")
    vectors = _literal([{k: v[k] for k in ("licence", "w")} for v in model["texts"]], "array<struct<licence:string,w:array<double>>>")
    needs = _literal([{k: v[k] for k in ("terms", "needed")} for v in model["texts"]], "array<struct<terms:array<string>,needed:int>>")

    def add(a: Column, x: Column) -> Column:
        return a + x

    def weights(s: Column) -> Column:
        """Of sorted tokens the distinct ones: place in the vocabulary from 1, or 0, and weight."""
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def weight(place: Column, n: Column) -> Column:
            return F.struct(place.alias("p"), ((1 + F.log(n.cast("double"))) * F.coalesce(F.get(idf, place - 1), F.lit(1.0))).alias("w"))

        return let(starts, lambda at: F.transform(at, lambda i, k: let(
            F.array_position(vocabulary, F.get(s, i)).cast("int"), lambda p: weight(p, F.coalesce(F.get(at, k + 1), F.size(s)) - i))))

    def best(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x["w"] * x["w"]), F.lit(0.0), add))

        def score(n: Column) -> Column:
            known = F.filter(v, lambda x: x["p"] > 0)
            scores = let(known, lambda ks: F.transform(vectors, lambda t: F.struct(
                F.round(F.aggregate(ks, F.lit(0.0), lambda a, x: a + F.get(t["w"], x["p"] - 1) * x["w"]) / n, 9).alias("score"), t["licence"].alias("licence"))))
            return F.aggregate(scores, F.struct(F.lit(-1.0).alias("score"), F.lit("").alias("licence")),
                               lambda a, x: F.when(x["score"] > a["score"], x).otherwise(a))

        return let(norm, score)

    def of(tokens: Column) -> Column:
        def enough(held: Column) -> Column:
            return (F.size(held) >= model["needed"]) & F.exists(needs, lambda t: F.size(F.array_intersect(t["terms"], held)) >= t["needed"])

        found = F.when(let(F.array_intersect(vocabulary, tokens), enough), let(let(F.sort_array(tokens), weights), best))
        return let(found, lambda f: F.when(f["score"] >= least, f))

    return let(_tokens(F.coalesce(text, F.lit(""))), of)


def directory(path: Column) -> Column:
    """The path without its last part; empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, least: float = LEAST_COSINE, file_share: float = FILE_SHARE, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """All columns of ``files`` but text, and a struct ``licence_``: licence, score, basis and licence_file.

    ``files`` has path and text.  basis is 'own' for a licence's whole text or a sentence in the file, 'inherited'
    for a licence file in the nearest directory at or above the file's own, and 'none'.
    Of several licence files in one directory the one with the smallest path counts.
    NULL and empty texts match nothing and inherit like others; a NULL path is a file at
    the top.  Repeated rows give equal rows; an empty table gives an empty table.
    """
    texts = texts or templates()
    fulls = full_texts()
    df, n = document_frequencies(files, texts + fulls)
    model, whole_model = weigh(df, n, least, texts), weigh_whole(df, n, WHOLE_COSINE, fulls)
    path = F.coalesce(F.col("path"), F.lit(""))
    m = F.col("match_")
    rows = files.withColumn("match_", best_matches(F.col("text"), model, least)).withColumn("whole_", whole_match(F.col("text"), whole_model, WHOLE_COSINE)).drop("text")
    rows = stored(rows.withColumn("directory_", directory(path)), "licence-matches")
    # A whole text says more than the sentences in it, which may speak of other licences.
    rows = rows.withColumn("own_", F.coalesce(F.col("whole_"), m["best"]))
    own = F.col("own_")
    whole = F.col("whole_").isNotNull() | (m["best"].isNotNull() & (m["matched_words"] >= m["words"] * file_share))
    covering = rows.filter(whole).groupBy(F.col("directory_").alias("above")).agg(
        F.min(F.struct(path.alias("file"), own["licence"].alias("licence"), own["score"].alias("score"))).alias("covering_"))
    parts = F.split("directory_", "/")
    steps = F.sequence(F.lit(0), F.size(parts))
    above = F.transform(steps, lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")))
    # Joined once per directory, not per file: a directory with many files is one row here.
    places = rows.filter(own.isNull()).select("directory_").distinct().select("directory_", F.inline(F.array_distinct(above)))
    nearest = places.join(covering, "above").groupBy("directory_").agg(F.max_by("covering_", "depth").alias("covering_"))
    joined = rows.join(nearest.withColumnRenamed("directory_", "inherits_"), (F.col("directory_") == F.col("inherits_")) & own.isNull(), "left")
    c = F.col("covering_")
    licence = F.struct(
        F.coalesce(own["licence"], c["licence"]).alias("licence"), F.coalesce(own["score"], c["score"]).alias("score"),
        F.when(own.isNotNull(), "own").when(c.isNotNull(), "inherited").otherwise("none").alias("basis"),
        F.when(own.isNull(), c["file"]).alias("licence_file"))
    return joined.select(*[rows[x] for x in files.columns if x != "text"], licence.alias("licence_"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source, language and thousand of the id are the directories."""
    part = [F.coalesce(F.col("source"), F.lit("unknown")), F.coalesce(F.col("lang"), F.lit("unknown")),
            F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("unknown")), F.coalesce(F.col("doc_id").cast("string"), F.lit("unknown"))]
    return docs.select("doc_id", "text", F.concat_ws("/", *part).alias("path"))


def licence_report(docs: DataFrame) -> DataFrame:
    s = F.col("licence_")
    return scan(document_paths(docs)).select(
        "doc_id", "path", *[s[c].alias(c) for c in ("licence", "score", "basis", "licence_file")])
