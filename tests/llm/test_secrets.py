import hashlib
import re

from odd import ODD

from millrace.llm import secrets

KINDS = ("assign", "access", "hex", "owned")


def base(text):
    found = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in sorted(found))


def check(df, texts):
    rows = secrets.scan(df).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = base(texts[row.doc_id] or "")
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in row.spans.split(",") if s and not s.startswith("owned")] == [s for s in want.split(",") if s]
    return {row.doc_id: row for row in rows}


def test_corpus(corpus, texts):
    check(corpus, texts)


def test_shapes(documents):
    key = "AKIA" + "Q7" * 9
    texts = [*ODD, f"é🙂 token: token: abcdef password=\"hunter22\" {key} {'0a' * 13}", f"API_KEY = {'ab' * 14}",
             "secret:abc", "AKIA1234 " + "f" * 23, f"x{key}{key}"]
    check(documents(texts), dict(enumerate(texts)))


def test_ownership(spark):
    live, copied = "Zx9" * 10, "Qw8" * 10
    rows = [(0, f"a {live} b", "o1"), (1, f"{copied}", "o1"), (2, f"{copied} {copied}", "o2"), (3, copied, None)]
    df = spark.createDataFrame([(i, t, "en", o) for i, t, o in rows], "doc_id bigint, text string, lang string, source string")
    found = {row.doc_id: row for row in secrets.scan(df).collect()}
    assert found[0].spans == "owned:2:32" and (found[0].n_live, found[0].n_copied) == (1, 0)
    assert [found[i].spans for i in (1, 2, 3)] == ["", "", ""] and [found[i].n_copied for i in (1, 2, 3)] == [1, 2, 1]
    held = secrets.ownership(secrets.candidates(df)).where("n_owners = 3").first()
    assert (held.n_occurrences, held.n_repositories) == (4, 3)


def test_empty(documents):
    assert secrets.scan(documents([])).count() == 0
