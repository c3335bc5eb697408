import re
from collections import Counter

from samples import prose

from apportion.llm.line_quality import LineRules, clean_documents, failed_rule, line_quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def digest(df):
    return Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect())


def test_base_against_brute_force(spark, odd_docs, odd_texts, clashing):
    expected = Counter((i, *brute(t or "")) for i, t in odd_texts)
    assert digest(line_quality(odd_docs)) == expected
    assert digest(line_quality(clashing, with_text=False)) == expected


def test_base_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert digest(line_quality(docs)) == Counter((r.doc_id, *brute(r.text)) for r in docs.collect())


def test_rules_by_line():
    rules = LineRules()
    assert failed_rule("A sentence of plain prose, closed by a mark.", rules) is None
    assert failed_rule("home | about | news | contact", rules) == "navigation"
    assert failed_rule("buy%%% now&&& cheap$$$ today***", rules) == "symbols"
    assert failed_rule("EVERYTHING HERE IS SHOUTED AT YOU!", rules) == "capitals"
    assert failed_rule("We use cookies to improve this site.", rules) == "boilerplate"
    assert failed_rule("Next page", rules) == "punctuation"


def test_verdict_and_cleaning(spark):
    good = "\n".join(f"{prose(k, 9).capitalize()}." for k in range(12))
    menu = "\n".join("alpha%d | beta | gamma | delta" % k for k in range(40))
    rows = [(1, good), (2, good + "\nhome | shop | help | login"), (3, good + "\n" + menu)]
    docs = spark.createDataFrame([(i, t, len(t), "x") for i, t in rows], "doc_id long, text string, n_chars long, kept string")
    out = {r.doc_id: r for r in clean_documents(docs).collect()}
    assert set(out) == {1, 2} and out[1].text == good and out[2].text == good and out[2].n_chars == len(good) and out[1].kept == "x"


def test_labels_hold(spark):
    sf = "/root/testdata/sf0.01"
    got = line_quality(spark.read.parquet(f"{sf}/documents.parquet"), with_text=False).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) < 0.05 * len(bad)


def test_no_rows(no_docs):
    assert line_quality(no_docs).collect() == [] and clean_documents(no_docs).collect() == []
