import math
import re

import pytest

from common import empty_documents, lower_ascii, odd_documents, tables
from stockrecon.llm.lexical import rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=10):
    bags = [(i, TERM.findall(lower_ascii(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, bag in bags:
        for term in set(bag):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(TERM.findall(lower_ascii(text)))
    out = []
    for item, terms in asked.items():
        found = []
        for doc, bag in bags:
            m = 10 + 90 * len(bag) * n_docs // n_terms
            score = 0
            for term in terms & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                tf = bag.count(term)
                score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def test_small_tables(spark):
    docs, items = tables(spark, "documents").limit(120), tables(spark, "benchmark")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = brute(rows, asked)
    assert got(rank_documents(docs, items)) == want
    # Blocks of items, and fewer rows of an answer.
    assert got(rank_documents(docs, items, block_items=7)) == want
    assert got(rank_documents(docs, items, k=2)) == brute(rows, asked, 2)


COPIES = [(100 - i, "Red fish, blue fish") for i in range(30)] + [
    (200 + i, "blue fish red FISH") for i in range(5)
] + [(7, "red"), (8, "Äpfel"), (9, "ÄPFEL äpfel"), (10, None), (11, "-- __ !"), (12, "green")]


def test_copies_expand_by_id_and_ties_cross_classes(spark):
    # Equal scores in two classes: the same terms, but another one that no item asks for.
    rows = COPIES + [(300, "red fish blue pond"), (1, "red pond blue fish")]
    items = [(1, "red FISH"), (2, "fish fish blue"), (3, "äpfel"), (4, None), (5, ""), (6, "zebra"),
             (None, "red"), (1, "green")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(rank_documents(docs, asked)) == brute(rows, items)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    docs = docs.unionByName(docs).unionByName(
        spark.createDataFrame([(3, "same other")], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "same text"), (2, "word5 more"), (3, "x" * 300_000), (4, "one Äpfel 中文")]
    asked = spark.createDataFrame(
        [(*i, "clash", 1) for i in items], "item_id long, text string, doc_id string, n int"
    )
    assert got(rank_documents(docs, asked)) == brute(rows, items)
    assert rank_documents(empty_documents(spark), asked).count() == 0
    assert rank_documents(docs, asked.limit(0)).count() == 0
    only_null = docs.where("doc_id is null")
    assert rank_documents(only_null, asked).count() == 0


@pytest.mark.parametrize("text", ["!!", None])
def test_documents_without_terms(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert rank_documents(docs, asked).count() == 0
