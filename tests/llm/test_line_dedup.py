import collections
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import SF, docs_of, rows_of

from shelfcast.llm.linededup import dedup_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20 and d is not None:
                held[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held[key(x)]) >= 3 and d != max(held[key(x)]))]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


LONG = "This line is repeated boilerplate"
EDGE = [
    (1, f"{LONG}\nown text one"), (2, f"  {LONG.upper()}\t\nown text two"), (3, f"{LONG}\n{LONG}\nkeeper"),
    (4, None), (5, ""), (6, "\n\n"), (7, "short line\nshort line"), (8, "short line"), (9, "short line"),
    (10, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"), (11, "éééééééééééééééééééé"), (12, "é" * 19), (13, "é" * 19), (14, "é" * 19),
    (None, f"{LONG}\nnameless"), (3, f"{LONG}\nsecond row of three"), (3, f"{LONG}\n{LONG}\nkeeper"),
    (20, "x" * 200_000 + "\n" + LONG), (21, "no trailing\n"),
]


def test_edge_rows_match_brute_force(spark):
    got = rows_of(dedup_lines(docs_of(spark, EDGE, extra=("key", "positions", "text_hash", "drop", "keeper"))))
    assert got == brute(EDGE)


def test_empty_table(spark):
    assert dedup_lines(docs_of(spark, [])).count() == 0


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(dedup_lines(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from([LONG, " " + LONG, "another line that is long enough", "s", ""]), max_size=5), max_size=8))
def test_property(spark, texts):
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    assert rows_of(dedup_lines(docs_of(spark, rows))) == brute(rows)


def test_key_alphabet():
    assert re.sub("[A-Z]", "", "AbZ").translate(LOWER) == "b"
