"""Line-first cleaning.

Every line of a document is judged on its own: closing punctuation,
navigation, symbols, capitals and boilerplate. Failing lines go; the document
is rejected if it fails the base rule or loses too much of its text with them.

A null or empty text has no words and is rejected. Repeated rows are judged
alike. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from apportion.llm.common import kept_in_worker, text_slices

SYMBOLS = "#*$%&|<>"
#: What closes a line of prose, before quotes and brackets.
CLOSING = ".!?:;…。！？"
QUOTES = "\"'”’»)]"
SEPARATORS = frozenset("| || / // > >> » › · • - – — * ← →".split())
#: Phrases of page furniture (fixed list), matched in lower case.
BOILERPLATE = re.compile(
    r"cookie|privacy policy|terms of (?:use|service)|all rights reserved|copyright ©|©|javascript|lorem ipsum|click here|"
    r"read more|sign (?:in|up)|log ?in|subscribe|newsletter|back to top|share (?:this|on)|follow us|skip to content"
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict on the whole document."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_per_word: float = 0.3
    max_separator_share: float = 0.2
    max_upper_share: float = 0.8
    min_cased: int = 12
    open_line_words: int = 6
    boilerplate_words: int = 30
    max_lost_share: float = 0.3


def failed_rule(line: str, rules: LineRules) -> str | None:
    """The first rule that a line with words fails, or None."""
    words = line.split()
    n = len(words)
    if sum(map(line.count, SYMBOLS)) > rules.max_symbols_per_word * n:
        separators = sum(w in SEPARATORS for w in words)
        return "navigation" if separators > rules.max_separator_share * n else "symbols"
    if sum(w in SEPARATORS for w in words) > rules.max_separator_share * n:
        return "navigation"
    low = line.lower()
    if line != low and sum(map(str.isupper, words)) * 2 > n:  # cheap first: most words of the line are in capitals
        cased = sum(c.lower() != c.upper() for c in line)
        if cased >= rules.min_cased and sum(map(str.isupper, line)) > rules.max_upper_share * cased:
            return "capitals"
    if n <= rules.boilerplate_words and BOILERPLATE.search(low):
        return "boilerplate"
    if n <= rules.open_line_words and line.rstrip().rstrip(QUOTES)[-1:] not in CLOSING:
        return "punctuation"
    return None


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pair = ids[:-1] * len(known) + ids[1:]
    if len(known) > 1 << 20:  # a third factor would leave 64 bits
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    _, back, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[back] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def judge(text: str, rules: LineRules) -> tuple[tuple, str]:
    """Digest columns of one text, and the text without its failing lines."""
    words = text.encode().split()
    n_words, n_chars = len(words), len(text) - sum(map(text.count, " \t\n\v\f\r"))
    seen: set[str] = set()
    kept, lost, n_lines, n_dup = [], 0, 0, 0
    verdicts: dict[str, str | None] = {}
    failed = {"symbols": 0, "navigation": 0, "capitals": 0, "boilerplate": 0, "punctuation": 0}
    for line in text.split("\n"):
        if not line.strip(" \t\v\f\r"):
            kept.append(line)
            continue
        n_lines += 1
        if line in seen:
            n_dup += 1
            why = verdicts[line]
        else:
            seen.add(line)
            why = verdicts[line] = failed_rule(line, rules) if line.strip() else None
        if why is None:
            kept.append(line)
        else:
            failed[why] += 1
            lost += len(line) - sum(map(line.count, " \t\v\f\r"))
    n_repeat = repeat_words(words)
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_pct * n_words
    good = not base_failed and lost <= rules.max_lost_share * n_chars
    cleaned = "\n".join(kept) if lost else text
    return (n_words, n_chars, sum(map(text.count, SYMBOLS)), n_dup, n_repeat, base_failed, good, n_lines, sum(failed.values()), n_chars - lost), cleaned


DIGEST = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_lines long, n_failed_lines long, kept_word_chars long"
)


def line_quality(docs: DataFrame, rules: LineRules | None = None, with_text: bool = True) -> DataFrame:
    """doc_id, the digest columns and (``with_text``) the text left by the line rules."""
    rules = rules or LineRules()
    schema = f"doc_id long, {DIGEST}" + ", clean_text string" * with_text

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        kept_in_worker("lines", lambda: None)  # other operators' tables go
        for part in text_slices(batches):
            ids, out = part.column("doc_id"), []
            for text in part.column("text").to_pylist():
                digest, cleaned = judge(text or "", rules)
                out.append((*digest, cleaned) if with_text else digest)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in zip(*out))], names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, schema)


def clean_documents(docs: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """The documents that pass, each with its failing lines removed and ``n_chars`` (if there) to match."""
    rules = rules or LineRules()
    names = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_in_worker("lines", lambda: None)
        for part in text_slices(batches):
            judged = [judge(text or "", rules) for text in part.column("text").to_pylist()]
            keep = pa.array([digest[6] for digest, _ in judged], pa.bool_())
            cleaned = [text for _, text in judged]
            new = {"text": pa.array(cleaned, part.schema.field("text").type)}
            if "n_chars" in names:
                new["n_chars"] = pa.array([len(x) for x in cleaned]).cast(part.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in names], names=names).filter(keep)

    return docs.mapInArrow(run, docs.schema)
