import random

import pytest

from quern.llm import html_text


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_copies_at_many_paths_find_the_pages_around_their_run(spark, parts):
    rng = random.Random(8)
    rows = []
    for host in ("a.org", "b.org", "c.org"):
        path = 0
        for run in range(rng.choice([1, 6])):
            for _ in range(rng.choice([1, 4, 30])):
                path += 1
                rows.append((len(rows), f"http://{host}/p/{path:04d}", f"<p>menu {host}<p>text {host} {run}"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        every = html_text.parsed(df, "page_id", "url", "html")
        keys = {(r["k1"], r["k2"]): r["page_id"] for r in every.collect()}
        got = {keys[r["k1"], r["k2"]]: tuple(keys.get((r[f"{c}1"], r[f"{c}2"])) for c in "ba") for r in html_text.partners(every).collect()}
        texts = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    host = lambda i: rows[i][1].split("/")[2]
    want = {i: tuple(next((j for j in side if host(j) == host(i) and rows[j][2] != page), None) for side in (range(i - 1, -1, -1), range(i + 1, len(rows)))) for i, _, page in rows}
    assert got == want
    for i, _, page in rows:
        lines = page.removeprefix("<p>").split("<p>")
        assert texts[i] == "\n".join(lines[1:] if any(x is not None for x in want[i]) else lines)
