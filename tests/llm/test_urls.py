import math
import re
import zlib
from collections import Counter

import pytest

from curbline.llm import urls


def plain_judge(rows, rules=urls.RULES, strength=4.0):
    """Rules, models and threshold in plain Python: {page_id: (host, path, rule, verdict, score)}."""
    def parts(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url)
        return (m[1].translate(str.maketrans(urls.UPPER, urls.LOWER)), m[2]) if m else ("", "")

    def rule_of(host, path):
        fits = [r for r, _ in rules if (host == (h := r.partition("/"))[0] or host.endswith("." + h[0]))
                and path.startswith(h[1] + h[2])]
        return max(fits, key=len, default=None)

    def grams(url):
        text = re.sub(r"[^a-z0./\-_?=&%:@+]", "~", re.sub("[0-9]", "0", url.lower()))
        text = "^^^" + text + "$" if url else ""
        return [text[i:i + 4] for i in range(len(text) - 3)]

    judged = []
    for page_id, url in rows:
        url = url or ""
        host, path = parts(url)
        rule = rule_of(host, path)
        judged.append((page_id, url, host, path, rule, dict(rules).get(rule), zlib.crc32(url.encode()) % 5 == 0))
    models = {}
    for kind in ("allow", "block"):
        counts = Counter(g for _, url, _, _, _, v, held in judged if v == kind and not held for g in grams(url))
        seen = Counter()
        for g, n in counts.items():
            for low in range(4):
                for high in range(low + 1, 5):
                    seen[low, g[low:high]] += n
        total = sum(counts.values())

        def probability(g, seen=seen, total=total):
            p = (seen[3, g[3]] + strength / len(urls.ALPHABET)) / (total + strength)
            for start in (2, 1, 0):
                p = (seen[start, g[start:]] + strength * p) / (seen[start, g[start:3]] + strength)
            return p

        models[kind] = probability
    ratio = {g: math.log(models["allow"](g)) - math.log(models["block"](g)) for row in judged for g in grams(row[1])}
    score = [sum(round(ratio[g] * 1e6) for g in grams(r[1])) / len(grams(r[1])) / 1e6 if r[1] else None for r in judged]
    stats = {}
    for kind in ("allow", "block"):
        own = [s for s, r in zip(score, judged, strict=True) if r[5] == kind and r[6] and s is not None]
        if own:
            m = sum(own) / len(own)
            stats[kind] = m, math.sqrt(sum((x - m) ** 2 for x in own) / len(own))
    least = 0.0
    if len(stats) == 2:
        (a, sa), (r, sr) = stats["allow"], stats["block"]
        least = (a * sr + r * sa) / (sa + sr) if sa + sr > 0 else (a + r) / 2
    return {r[0]: (r[2], r[3], r[4], r[5] or ("allow" if s is not None and s >= least else "block"), s)
            for r, s in zip(judged, score, strict=True)}


def check_urls(df):
    want = plain_judge([(r["page_id"], r["url"]) for r in df.collect()])
    found = {r["page_id"]: r for r in urls.judge(df).collect()}
    assert found.keys() == want.keys()
    for i, (*fixed, score) in want.items():
        r = found[i]
        assert [r["host"], r["path"], r["rule"], r["verdict"]] == fixed, r
        assert (r["score"] is None) == (score is None) and r["score"] == pytest.approx(score, abs=1e-5)
    return found


def test_pages_against_plain_python(spark):
    check_urls(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url"))


def test_models_read_whole_urls(spark):
    some = [f"https://example.net/en/{i}?topic=science&n={i}" for i in range(40)]
    some += [f"http://a.net/{i}?casino=win#jackpot{i}" for i in range(40)]
    some += ["https://new.test/x?topic=science&n=1", "https://new.test/x?casino=win#jackpot", "topic=science&n=7",
             "https://new.test/x", "", None, "ÄÖ://?", "http://A.Example.NET/en/?q"]
    found = check_urls(spark.createDataFrame(list(enumerate(some)), "page_id long, url string"))
    assert [found[80]["verdict"], found[81]["verdict"], found[82]["verdict"]] == ["allow", "block", "allow"]
    assert found[84]["score"] is found[85]["score"] is None


def test_no_pages(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
