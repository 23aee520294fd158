"""URL rules and their way through aliases."""

import random
import re

import pytest

from assayloom.llm.queries import URL_RULES
from assayloom.llm.url_filters import judge_urls

SCHEMA = "page_id long, url string, html string"


def judge(spark, rows, rules=URL_RULES, **kw):
    out = judge_urls(spark.createDataFrame(rows, SCHEMA), rules, **kw).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["by"]) for r in out}


def test_parts_and_rules(spark):
    rows = [
        (1, "HTTP://WWW.Example.ORG/es/x?y#z", None), (2, "https://example.org/en/12", ""), (3, "http://a.com/fr/1", "x"),
        (4, "http://a.com/de/1", None), (5, None, None), (6, "no scheme", None), (7, "http://net?x", None), (8, "http://notexample.org/es/", None),
        (9, "http://É.ORG#a://b", None), (10, "http://example.org/en/2", None), (11, "x://com", None), (12, "http://a.com/de", None),
    ]
    got = judge(spark, rows)
    assert got == {
        1: ("www.example.org", "/es/x", "example.org/es/", "block", "rule"), 2: ("example.org", "/en/12", "example.org/en/1", "block", "rule"),
        3: ("a.com", "/fr/1", "com/fr/", "allow", "rule"), 4: ("a.com", "/de/1", "com/de/", "block", "rule"),
        5: ("", "", None, "allow", "default"), 6: ("", "", None, "allow", "default"), 7: ("net", "", None, "allow", "default"),
        8: ("notexample.org", "/es/", "org/", "allow", "rule"), 9: ("É.org", "", None, "allow", "default"),
        10: ("example.org", "/en/2", "org/", "allow", "rule"), 11: ("com", "", None, "allow", "default"), 12: ("a.com", "/de", None, "allow", "default"),
    }


def test_aliases(spark):
    def canonical(to):
        return f"<html><head><LINK href='{to}' rel=\"canonical\"></head>"

    rows = [
        (1, "http://a.net/1", canonical("http://b.com/de/1")),  # alias of a blocked address
        (2, "https://a.net/2", canonical("/1#top")),  # alias of that alias
        (3, "http://a.com/fr/9", canonical("http://a.net/1")),  # an explicit allow stays one, and clears its class
        (4, "http://c.net/1", '<meta http-equiv="refresh" content="0; URL=\'//x.com/de/2?a=1&amp;b=2\'">'),
        (5, "http://x.com/de/2?a=1&b=2", None), (6, "http://d.net/x/1", canonical("2")), (7, "http://d.net/x/2", "<link rel=canonical href=mailto:x>"),
        (8, "http://e.net/", "<p>canonical</p><link rel=stylesheet href=http://b.com/de/1>"), (9, "http://e.net", None),
        (10, "http://f.net/1", None), (11, "http://f.net/1", None),
    ]
    redirects = spark.createDataFrame([("http://f.net/1", "http://b.com/de/7"), (None, "http://b.com/de/7"), ("x", None)], "source string, target string")
    got = {k: v[3:] for k, v in judge(spark, rows, redirects=redirects).items()}
    assert got == {
        1: ("allow", "alias"), 2: ("allow", "alias"), 3: ("allow", "rule"), 4: ("block", "alias"), 5: ("block", "rule"), 6: ("allow", "default"),
        7: ("allow", "default"), 8: ("allow", "default"), 9: ("allow", "default"), 10: ("block", "alias"), 11: ("block", "alias"),
    }
    assert judge(spark, [r for r in rows if r[0] != 3])[2][3:] == ("block", "alias")


def test_chain_against_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        to = rnd.choice(["", f"http://n.net/{rnd.randrange(300)}", f"http://n.net/{i + 1}", f"http://y.com/{rnd.choice(['de', 'fr'])}/{rnd.randrange(40)}"])
        rows.append((i, f"http://n.net/{i}", f'<link rel="canonical" href="{to}">'))
    near = {}
    for _, url, html in rows:
        to = re.search('href="(.*)"', html)[1]
        if to:
            near.setdefault(url, set()).add(to)
            near.setdefault(to, set()).add(url)
    got = judge(spark, rows)
    for i, url, _ in rows:
        seen, todo = {url}, [url]
        while todo:
            new = near.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        want = "allow" if any("/fr/" in u for u in seen) else "block" if any("/de/" in u for u in seen) else "allow"
        assert got[i][3] == want


@pytest.mark.parametrize("as_table", [False, True])
def test_list_and_table_of_rules_agree(spark, as_table):
    rnd = random.Random(9)
    hosts = ["a.com", "b.a.com", "com", "c.org", "x.c.org", "A.COM"]
    rules = [(rnd.choice(["allow", "block"]), f"{rnd.choice(hosts)}/{'/'.join(rnd.choice('xyz') for _ in range(rnd.randrange(3)))}") for _ in range(60 if as_table else 18)]
    rows = [(i, f"http://{rnd.choice(['', 'q.'])}{rnd.choice(hosts)}/{'/'.join(rnd.choice('xyz') for _ in range(rnd.randrange(5)))}", None) for i in range(200)]
    given = spark.createDataFrame(rules, "action string, rule string") if as_table else rules
    got = judge(spark, rows, given)
    for i, (host, path, rule, verdict, _) in got.items():
        fits = []
        for action, text in rules:
            at, slash, start = text.partition("/")
            at = at.lower()
            if (host == at or host.endswith("." + at)) and path.startswith(slash + start):
                fits.append((len(text), action == "allow", text, action))
        want = max(fits, default=(0, 0, None, "allow"))
        assert (rule, verdict) == want[2:], (i, host, path)


def test_empty_table_and_clashing_names(spark):
    assert judge(spark, []) == {}
    df = spark.createDataFrame([(1, "http://a.com/de/1", None, 3, 4, "x")], SCHEMA + ", node int, id int, rule string")
    assert judge_urls(df, URL_RULES).collect()[0]["verdict"] == "block"
