"""Verdicts of urls without a rule: by the labelled urls of their template, on their host and on all."""

import re
from collections import defaultdict

from ledgerloom.llm.url_templates import PURITY, RULES, url_filter


def rule_of(host, path):
    fits = []
    for verdict, rule in RULES:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((len(rule), verdict))
    return max(fits)[1] if fits else None


def test_hosts_without_labels_are_judged_by_the_others(spark):
    urls = [f"http://a{i % 6}.net/casino/{i}" for i in range(40)]  # blocked by their rule
    urls += [f"http://example.net/en/news/{i}" for i in range(20)]  # allowed
    urls += [f"http://x.net/fr/mixed/{i}" for i in range(10)] + [f"http://example.org/fr/mixed/{i}" for i in range(10)]
    urls += ["http://new.io/casino/7", "http://old.io/en/news/7", "http://own.io/fr/mixed/1", "http://other.io/unseen/page", None]
    rows = [(i, u, "t") for i, u in enumerate(urls)]
    got = url_filter(spark.createDataFrame(rows, "page_id long, url string, verdict string")).collect()
    counts, pooled, shapes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), defaultdict(set)
    shape = lambda path: re.sub(r"\d+", "{n}", path)
    for r in got:
        shapes[r.host, r.template].add(shape(r.path))
        if (v := rule_of(r.host, r.path)) is not None:
            for table, key in ((counts, (r.host, r.template)), (pooled, shape(r.path))):
                table[key][v != "block"] += 1
    for r in got:
        b, g = counts[r.host, r.template]
        all_b, all_g = (sum(pooled[s][k] for s in shapes[r.host, r.template]) for k in (0, 1))
        purity = (b + 4 * (all_b + 2) / (all_b + all_g + 4)) / (b + g + 4)
        assert abs(r.purity - purity) < 1e-12
        assert r.verdict == (rule_of(r.host, r.path) or ("block" if purity >= PURITY else "allow"))
    verdicts = {r.page_id: (r.rule, r.verdict) for r in got}
    n = len(urls) - 5
    assert [verdicts[n + k] for k in range(5)] == [(None, "block"), *[(None, "allow")] * 4]
