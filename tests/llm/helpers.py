"""Small tables for the operators' tests and plain-Python counterparts."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PROSE = ("the quick brown fox jumps over a lazy dog while seven wise men walk along some quiet river bank "
         "and speak of many things that nobody else has ever heard before today").split()


def prose(start: int, n: int) -> str:
    return " ".join(f"{PROSE[(start + k * (1 + start % 7)) % len(PROSE)]}{(start * 31 + k) % 50}" for k in range(n))


LONG = prose(3, 6000)
EDGE_ROWS = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, "one", "en", "b", 3),
    (5, prose(5, 60), "en", "b", 1), (5, prose(5, 60), "en", "b", 1),                # repeated row
    (6, prose(5, 60), "de", "c", 1), (None, prose(9, 40) + "\n" + prose(8, 30), "en", None, 1),
    (7, LONG, "en", "a", len(LONG)), (8, "été ñandú — 日本語 😀 " + prose(2, 12), "fr", "a", 1),
    (None, None, None, None, None), (9, prose(5, 60) + " end", "en", "a", 1),
]


def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs):
    """The same rows with columns named like the operators' own."""
    out = docs
    for c in ("shard", "slot", "id", "key", "h", "tk", "ln", "n", "score", "_t", "_row", "_src", "_rank", "_r",
              "_label", "comp", "block", "words", "counts", "first", "keep", "drops"):
        out = out.selectExpr("*", f"'x' AS `{c}`")
    return out


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size=5):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def crc_fold(doc_id):
    import zlib
    return 1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 3
