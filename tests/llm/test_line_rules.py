"""Base counts and line verdicts against plain Python."""

import re
from collections import Counter, defaultdict

from rillmart.llm import line_rules

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def verdicts(rows, least_texts, least_share, least_left):
    """Of (text, source) rows: kept, and the text that is left."""
    def normal(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()

    hosts = defaultdict(set)
    for text, source in rows:
        hosts[source].add(text or "")
    often = {}
    for host, texts in hosts.items():
        n = Counter(x for t in texts for x in {normal(y) for y in t.split("\n")} if x)
        often[host] = {x for x, k in n.items() if k > least_texts and k > least_share * len(texts)}
    out = []
    for text, source in rows:
        left = "\n".join(x for x in (text or "").split("\n") if normal(x) not in often[source])
        b = base(text)
        out.append((not b[5] and len(WORD.findall(left)) >= least_left * b[0], left))
    return out


def test_base_counts_and_verdicts(spark, documents, edges):
    for docs in (documents, edges):
        rows = line_rules.rules_report(docs).collect()
        texts = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        want = verdicts([(t, s) for _, t, s in texts], line_rules.LEAST_TEXTS, line_rules.LEAST_SHARE, line_rules.LEAST_LEFT)
        have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in rows)
        assert have == Counter((i, *base(t), k) for (i, t, _), (k, _) in zip(texts, want, strict=True))


def test_frequent_lines_are_cut_per_host(docs_of):
    body = [prose(100 + i, 70) for i in range(40)]
    rows = [(i, f"Accept  all COOKIES\n{body[i]}", "h") for i in range(30)]
    rows += [(100 + i, f"accept all cookies\n{body[30 + i]}", "other") for i in range(3)]
    # Copies of one text count once: their lines stay.
    rows += [(200 + i, prose(999, 60), "h") for i in range(30)]
    # A document that is mostly shared lines is rejected.
    shared = "\n".join(prose(500 + k, 20) for k in range(4))
    rows += [(300 + i, shared + "\n" + prose(600 + i, 5), None) for i in range(25)]
    docs = docs_of(rows)
    got = {r.doc_id: (r.rules_.kept, r.rules_.clean_text) for r in line_rules.line_rules(docs).collect()}
    want = verdicts([(t, s) for _, t, s in rows], line_rules.LEAST_TEXTS, line_rules.LEAST_SHARE, line_rules.LEAST_LEFT)
    assert got == {i: w for (i, _, _), w in zip(rows, want, strict=True)}
    assert got[0] == (True, body[0]) and got[100][1].startswith("accept") and got[200][0] and not got[300][0]
    kept = line_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (k, _) in got.items() if k}
    assert all(r.n_chars == len(r.text) for r in kept.collect())


def test_no_python_and_empty(no_rows, documents):
    assert line_rules.rules_report(no_rows).collect() == []
    plan = line_rules.rules_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
