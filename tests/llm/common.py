"""Small frames with every oddity the operators must stand."""

import re
import sys

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, fp string"


def odd_documents(spark):
    rows = [
        (1, None, "en", "a", 0),
        (2, "", None, None, 0),
        (3, "Same Text here", "en", "a", 14),
        (4, "same text HERE", "de", "b", 14),
        (4, "same text HERE", "de", "b", 14),
        (None, "same text here", "en", None, 14),
        (6, " \t\n\x0b", "en", "a", 4),
        (7, "Äpfel ÄPFEL äpfel don't we'LL 'tis it's  \n\n x y 12½ 中文 😀😀", "de", "c", 1),
        (8, "".join(f"word{i % 977} and more of it " for i in range(12_000)), "en", "c", 1),
        (9, "x" * 300_000 + " " * 5_000 + "!" * 3_000, None, "d", 1),
        (10, "one\ntwo\n\nthree", "en", "", 1),
    ]
    return spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def lower_ascii(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def tables(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def small_copy(spark, folder, doc_rows=60):
    """The small tables with fewer documents, for brute force, as a folder of tables."""
    keep = tables(spark, "documents").orderBy("doc_id").limit(doc_rows)
    keep.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    for name in ("labels", "conversations", "pages", "embeddings"):
        tables(spark, name).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
