from unittest import mock

import xxhash

from plume.llm import urlfilter
from plume.llm.registry import URL_RULES

URLS = ["http://a.com/x", "https://EXAMPLE.com/en/1?q=/en/", "http://www.example.com/en/", "http://example.com/EN/", "http://xexample.com/en/",
        "http://net/es/1", "http://a.b.net/fr/#x", "http://a.b.net/it/", "com/", "", None, "http://com", "http://com?/", "http://com#/",
        "://com/", "http://a..com/", "http://a.com:80/", "x://y://com/", "http://ünï.NET/es/", "http://b.com/" + "p" * 50_000, "http://.com/"]


def brute(url):
    _, mark, rest = (url or "").partition("://")
    host = path = ""
    if mark:
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:n].encode().lower().decode(), rest[n:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")


def test_both_ways_equal_brute_force(spark):
    rows = pages(spark, [*URLS, *URLS])
    want = {i: brute(u) for i, u in enumerate([*URLS, *URLS])}
    got = urlfilter.judge(rows, URL_RULES).collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    assert {r.page_id: tuple(r)[1:] for r in urlfilter.judge_by_join(rows, rules).collect()} == want


def test_a_host_of_many_dots_gives_few_keys(spark):
    hosts = sorted({len(h) for _, h, _ in URL_RULES})
    paths = sorted({len(p) for _, _, p in URL_RULES})
    keys = urlfilter.candidates("a." * 50_000 + "net", "/es/x", hosts, paths)
    assert len(keys) <= len(hosts) * len(paths) and keys[-1] == "net/" and "net/es/" in keys
    assert urlfilter.candidates("a.", "/", [0, 1, 2], [1]) == ["a./", "/"] and urlfilter.candidates("xcom", "/", [3], [1]) == []
    rows = pages(spark, ["http://" + "a." * 50_000 + "net/es/", "http://" + "." * 50_000 + "com/"])
    assert [r.rule for r in urlfilter.judge(rows, URL_RULES).orderBy("page_id").collect()] == ["net/es/", "com/"]


def test_collisions_cannot_decide(tmp_path):
    with mock.patch.object(xxhash, "xxh64_intdigest", lambda b: 7):
        image = tmp_path / "r"
        image.write_bytes(urlfilter.pack_rules(URL_RULES))
        found = urlfilter.Rules(str(image)).find([b"com/", b"org/", b"net/es/"])
        assert (found >= 0).tolist() == [True, False, True] and found[0] != found[2]


def test_empty_list_default_repeats_and_bad_rules(spark):
    rows = pages(spark, ["http://a.com/", None])
    assert {r.verdict for r in urlfilter.judge(rows, [], default="block").collect()} == {"block"}
    both = [("allow", "COM", "/"), ("block", "com", "/")]
    assert urlfilter.judge(rows, both).where("page_id = 0").first().verdict == "block"
    assert urlfilter.judge(pages(spark, []), URL_RULES).collect() == []
    for bad, how in ((["deny", "a", "/"], {}), (("block", "a", "/"), {"max_image_bytes": 3})):
        try:
            urlfilter.judge(rows, [tuple(bad)], **how)
        except ValueError:
            continue
        raise AssertionError(bad)
