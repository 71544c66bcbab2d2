import re
import zlib
from collections import Counter

from common import empty_documents, odd_documents, tables
from stockrecon.llm.spelling import group_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_count=5):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= min_count}
    beside, form = {}, {}
    for w in words:
        beside[w] = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and near(v, w)]
        best = max(beside[w], key=lambda v: (words[v], [-ord(c) for c in v] + [1]), default=None)
        ties = [v for v in beside[w] if best and words[v] == words[best]]
        best = min(ties, default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(beside[w]), words.get(form[w])))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_small_table(spark):
    docs = tables(spark, "documents")
    assert got(group_variants(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


PLANTED = {
    "letters": 700, "leters": 6, "lettters": 5, "letterss": 5, "setters": 130, "letter": 140,
    "lettor": 28, "lettxr": 5, "Ãpfelmus": 50, "Ápfelmus": 50, "Äpfelmus": 9, "äpfelmus": 45,
    "aaaaaa": 60, "aaaaaaa": 10, "aaaaaaaa": 5, "baaaaaa": 7, "aaabaaa": 7, "kitten": 4,
    "mitten": 100, "straße": 50, "strasse": 10, "strase": 50,
}


def test_planted_words(spark):
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(PLANTED.items(), 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    answer = got(group_variants(docs))
    assert answer == brute(rows)
    found = {r[0]: r for r in answer}
    assert found["leters"][1] == "letters" and found["lettxr"][2] != "lettxr"
    # Chains, ties and words that several deletions lead to occur in the planted words.
    assert any(r[1] and r[1] != r[2] for r in answer)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    long = [(50 + i, f"{'q' * 40_000} {'Q' * 39_999}r") for i in range(6)]
    docs = docs.unionByName(docs).unionByName(
        spark.createDataFrame(long, "doc_id long, text string"), allowMissingColumns=True
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(group_variants(docs)) == brute(rows)
    assert group_variants(empty_documents(spark)).count() == 0


def test_no_variants_at_all(spark):
    docs = spark.createDataFrame([(1, "wonders " * 9)], "doc_id long, text string")
    assert got(group_variants(docs)) == brute([(1, "wonders " * 9)])
