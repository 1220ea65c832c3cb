"""Small inputs with the awkward cases, and plain forms of what the operators must return."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(_LOWER)


def rows(texts, source="src"):
    return [(i, t, "en", source, len(t) if t is not None else None) for i, t in enumerate(texts)]


def docs(spark, texts, **kw):
    return spark.createDataFrame(rows(texts, **kw), DOCS)


#: Null, empty, blank, one word, odd spaces, NUL, non-ASCII, repeats, a long text.
ODD = [None, "", "   \n\t ", "word", "a\x0bb\x0cc\rd\x1ce\x85f g", "nul\x00inside A B", "a\x00b c d a\x01b c d x", "Ünïcödé ÄÖ straße 漢字 かな", "same line\nsame line\n\nsame line", "long " * 30000, "x" * 70000]
