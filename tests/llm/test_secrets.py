"""Secret spans against Python's own patterns, links against all pairs."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from assayloom.llm.queries import op2_secret_credential_links
from assayloom.llm.secrets import COMPLEMENTS, KINDS, REACH, ROLES, redacted, scan_secrets, written

KEYS = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = re.compile(KEYS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def spell(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(df):
    rows = scan_secrets(df, keep=["doc_id", "text"]).select("doc_id", "text", written(F.col("base")).alias("base"), written(F.col("spans")).alias("spans"),
                                                            redacted(F.coalesce("text", F.lit("")), F.col("spans")).alias("clean"))
    return [tuple(r) for r in rows.collect()]


def test_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op2_secret_credential_links(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(spell(base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert set(spell(base).split(",")) <= set(r["spans"].split(","))
    assert sum(r["n_assign"] for r in rows) and sum(r["n_hex"] for r in rows)


def test_base_spans_of_odd_texts(documents):
    rnd = random.Random(3)
    parts = ["password", "API_KEY", "apikey", "token", "ſecret", "secret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "0123456789abcdef", "é", "😀", "\n",
             "xyz-./+", "longvalue1234", "passwd"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (None, "token=abcdefabcdef1234"), (5, "token=abcdefabcdef1234"), (1002, "a" * 50_000 + " " + "deadbeef" * 1000)]
    got = scan(documents(rows))
    assert len(got) == len(rows)
    for doc_id, text, base, spans, clean in got:
        assert base == spell(plain_base(text)), text
        for span in spans.split(",") if spans else []:
            kind, start, end = span.split(":")
            assert 0 <= int(start) < int(end) <= len(text)
        assert "token=abcdef" not in clean


def test_weak_parts_need_complements(documents):
    far = "x " * 150
    rows = [
        (1, "user=alice and password=hunter2 here"),  # identifier and short secret
        (2, "password=hunter2 alone"), (3, "user=alice alone"), (4, "see https://host.example/x alone"),
        (5, f"user=alice {far} password=hunter2"),  # too far
        (6, "user=alice\n \npassword=hunter2"),  # another scope
        (7, "https://host.example/x password=hunter2"), (8, "10.0.0.1:5432 token=abcdefghijkl99"),
        (9, "AKIA12345678 secret=s3cr3t"), (10, "user=alice https://host.example/x"),
    ]
    got = {r[0]: [s.split(":")[0] for s in r[3].split(",") if s] for r in scan(documents(rows))}
    assert got == {1: ["weak_access", "weak_secret"], 2: [], 3: [], 4: [], 5: [], 6: [], 7: ["endpoint", "weak_secret"], 8: ["endpoint", "assign"],
                   9: ["weak_access", "weak_secret"], 10: []}
    clean = {r[0]: r[4] for r in scan(documents(rows))}
    assert clean[1] == "[SECRET] and [SECRET] here" and clean[2] == rows[1][1]


def test_links_against_all_pairs(spark):
    from assayloom.llm.secrets import linked_parts

    rnd = random.Random(8)
    kinds = list(ROLES)
    parts = sorted({(rnd.randrange(6), rnd.randrange(2), s := rnd.randrange(6000), KINDS.index(rnd.choice(kinds)), s + rnd.randrange(1, 500)) for _ in range(400)})
    got = {tuple(r) for r in linked_parts(spark.createDataFrame(parts, "key long, scope int, start int, rank int, end int")).collect()}
    want = set()
    for key, scope, start, rank, end in parts:
        if rank < 3:
            continue
        for key2, scope2, start2, rank2, _ in parts:
            if (key, scope) == (key2, scope2) and ROLES[KINDS[rank2]] in COMPLEMENTS[ROLES[KINDS[rank]]] and start - REACH <= start2 <= end + REACH:
                want.add((key, start, rank, end))
    assert got == want and 0 < len(want) < len(parts)


def test_empty_table_and_clashing_names(documents):
    assert scan(documents([])) == []
    clash = documents([(1, "token=abcdefghijkl99")]).withColumnsRenamed({"lang": "parts", "source": "_key", "n_chars": "_text"})
    assert len(scan_secrets(clash).collect()[0]["spans"]) == 1


def test_long_complements(documents):
    """A complement counts from its end too: long addresses and tokens right before a weak part."""
    rows = [(1, f"https://{'h' * 230} password=hunter2"), (2, f"token={'T' * 400} user_name=alice"), (3, f"user_name=alice token={'T' * 400}"),
            (4, f"token={'T' * 400}{' ' * 200}user_name=alice"), (5, f"token={'T' * 400}{' ' * 201}user_name=alice"), (6, f"https://{'h' * 2300} password=hunter2")]
    got = {r[0]: ([s.split(":")[0] for s in r[3].split(",") if s], r[4]) for r in scan(documents(rows))}
    both = ["endpoint", "weak_secret"], "[SECRET] [SECRET]"
    assert got[1] == got[6] == both
    assert sorted(got[2][0]) == sorted(got[3][0]) == sorted(got[4][0]) == ["assign", "weak_access"] and got[5][0] == ["assign"]


def test_whole_links_against_all_pairs(spark):
    from assayloom.llm.secrets import linked_parts

    rnd = random.Random(9)
    parts = sorted({(rnd.randrange(6), rnd.randrange(2), s := rnd.randrange(30_000), KINDS.index(rnd.choice(list(ROLES))), s + rnd.randrange(1, 900)) for _ in range(400)})
    got = {tuple(r) for r in linked_parts(spark.createDataFrame(parts, "key long, scope int, start int, rank int, end int"), whole=True).collect()}
    want = {(key, start, rank, end) for key, scope, start, rank, end in parts if rank >= 3 for key2, scope2, start2, rank2, end2 in parts
            if (key, scope) == (key2, scope2) and ROLES[KINDS[rank2]] in COMPLEMENTS[ROLES[KINDS[rank]]] and max(start2 - end, start - end2) <= REACH}
    assert got == want and 0 < len(want) < sum(p[3] >= 3 for p in parts)
