import datetime
import random
import time
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from viewstar.functions.agents import (
    BROWSER, MAX_RULES, RULE_SCHEMA, RULES, Rule, agent_tokens, rules_of)
from viewstar.functions.referrers import referrer_domain, referrer_type
from viewstar.functions.times import (
    calendar, date_key, epoch_seconds, event_date, event_time)
from viewstar.functions.urls import url_country
from viewstar.operators.agents import with_families


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "v string").select(*columns).first())


@pytest.mark.parametrize("text, date, time", [
    ("2024-01-07T10:00:00", "2024-01-07", "2024-01-07 10:00:00"),
    ("2024-01-07 10:00:00", "2024-01-07", "2024-01-07 10:00:00"),
    ("2024-1-5", "2024-01-05", "2024-01-05 00:00:00"),
    ("2024", "2024-01-01", "2024-01-01 00:00:00"),
    ("2024-02-30", None, None),
    ("2024-01-07T25:00:00", "2024-01-07", None),
    ("garbage", None, None),
    ("", None, None),
    (None, None, None),
])
def test_times(spark, text, date, time):
    got_date, got_time = one(spark, text, event_date("v"), event_time("v"))
    assert (None if got_date is None else str(got_date)) == date
    assert (None if got_time is None else str(got_time)) == time


def test_times_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for zone in ("UTC", "America/New_York", "Asia/Ho_Chi_Minh"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(one(spark, "2024-03-10T02:30:00",
                         epoch_seconds(event_time("v"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert seen == {(1710037800,)}


@pytest.mark.parametrize("date, key, weekday, week, quarter", [
    ("2024-01-07", 20240107, 1, 1, 1),
    ("2024-01-06", 20240106, 7, 1, 1),
    ("2024-01-01", 20240101, 2, 1, 1),
    ("2023-01-01", 20230101, 1, 52, 1),
    ("2024-02-29", 20240229, 5, 9, 1),
    ("2024-03-31", 20240331, 1, 13, 1),
    ("2024-04-01", 20240401, 2, 14, 2),
    ("2024-12-31", 20241231, 3, 1, 4),
])
def test_calendar(spark, date, key, weekday, week, quarter):
    value = F.col("v").cast("date")
    parts = calendar(value)
    got = one(spark, date, date_key(value), parts["day_of_week"], parts["week_of_year"],
              parts["quarter"], parts["year"], parts["month"], parts["day"])
    day = datetime.date.fromisoformat(date)
    assert got == (key, weekday, week, quarter, day.year, day.month, day.day)


@pytest.mark.parametrize("url, domain, kind", [
    ("https://www.google.com/search?u=facebook", "www.google.com", "Search Engine"),
    ("https://www.facebook.com/l", "www.facebook.com", "Social Media"),
    ("https://x.com/?q=google", "x.com", "Search Engine"),
    ("https://GOOGLE.com/", "GOOGLE.com", "Other"),
    ("direct", "", "Direct"),
    ("", "", "Other"),
    ("https://u@h.com:80/x", "u@h.com:80", "Other"),
    ("ftp://h.com/", "", "Other"),
    (None, None, "Other"),
])
def test_referrers(spark, url, domain, kind):
    assert one(spark, url, referrer_domain("v"), referrer_type("v")) == (domain, kind)


@pytest.mark.parametrize("url, country", [
    (None, "unknown"), ("", "unknown"), ("http://shop.VN/x", "vn"), ("http://a.com.vn", "vn"),
    ("http://www.co.com/", "co"), ("http://10.0.0.12/x", "12"), ("http://a.co.uk:80/", "co"),
    ("shop.vn/x", "unknown"), ("//b.vn?q=1", "vn"), ("http://u@c.vn", "vn"),
    ("http://[::1/x", "unknown"), ("  http://d.us/", "us"), ("mailto:a@b.vn", "unknown"),
    ("http://x.vn.", "vn"), ("http://localhost", "unknown"), ("ht\ttp://e.fr/", "fr"),
    ("1http://e.fr/", "unknown"), ("http://f.us#z", "us"), ("http://g.us\\x", "unknown"),
])
def test_url_country(spark, url, country):
    assert one(spark, url, url_country("v")) == (country,)


def test_url_country_on_random_urls(spark):
    """Against a restatement of the rule over the standard library's URL parser."""
    rng = random.Random(17)
    pieces = ["http:", "https:", "//", "/", ".", "..", "a", "vn", "US", "com", "co", "12", ":80",
              "@", "?", "#", " ", "\t", "\n", "x.y", "-", "é", "1a:", "+", "\\"]
    urls = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
            for _ in range(4000)]
    urls += ["http://" + url for url in urls]

    def expected(url):
        labels = urlsplit(url).netloc.split(".")
        if len(labels) >= 2 and len(labels[-1]) == 2:
            return labels[-1].lower()
        if len(labels) >= 3 and len(labels[-2]) == 2:
            return labels[-2].lower()
        return "unknown"

    df = spark.createDataFrame([(u,) for u in urls], "v string")
    for row in df.select("v", url_country("v").alias("c")).collect():
        assert row.c == expected(row.v), repr(row.v)


CHROME = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
AGENTS = [
    (CHROME + "Chrome/120.0.0.0 Safari/537.36", "Chrome", "Windows"),
    (CHROME + "Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0", "Edge", "Windows"),
    (CHROME + "Chrome/51.0 Safari/537.36 Edge/14.14393", "Edge", "Windows"),
    (CHROME + "Chrome/120.0.0.0 Safari/537.36 OPR/106.0.0.0", "Opera", "Windows"),
    (CHROME + "Chrome/120.0.0.0 Safari/537.36 Vivaldi/6.5", "Vivaldi", "Windows"),
    (CHROME + "coc_coc_browser/110.0 Chrome/104.0 Safari/537.36", "Coc Coc", "Windows"),
    (CHROME + "Chrome/120.0 YaBrowser/23.11 Safari/537.36", "Yandex Browser", "Windows"),
    ("Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Ubuntu "
     "Chromium/90.0 Chrome/90.0 Safari/537.36", "Chromium", "Ubuntu"),
    ("Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/120.0.0.0 Mobile Safari/537.36", "Chrome Mobile", "Android"),
    ("Mozilla/5.0 (Linux; Android 13; Pixel 7; wv) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Version/4.0 Chrome/120.0 Mobile Safari/537.36", "Chrome Mobile WebView", "Android"),
    ("Mozilla/5.0 (Linux; U; Android 4.0.3; en-us) AppleWebKit/534.30 (KHTML, like Gecko) "
     "Version/4.0 Mobile Safari/534.30", "Android", "Android"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like "
     "Gecko) Version/17.2 Mobile/15E148 Safari/604.1", "Mobile Safari", "iOS"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like "
     "Gecko) CriOS/120.0 Mobile/15E148 Safari/604.1", "Chrome Mobile iOS", "iOS"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like "
     "Gecko) FxiOS/120.0 Mobile/15E148 Safari/605.1.15", "Firefox iOS", "iOS"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/17.2 Safari/605.1.15", "Safari", "Mac OS X"),
    ("Mozilla/5.0 (Android 13; Mobile; rv:120.0) Gecko/120.0 Firefox/120.0", "Firefox Mobile",
     "Android"),
    ("Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0",
     "Firefox", "Fedora"),
    ("Mozilla/5.0 (compatible; MSIE 10.0; Windows NT 6.2)", "IE", "Windows"),
    ("Mozilla/5.0 (Mobile; Windows Phone 8.1; Android 4.0; Trident/7.0; IEMobile/11.0) like "
     "iPhone OS 7_0_3", "IE Mobile", "Windows Phone"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2) Mobile/15E148 [FBAN/FBIOS;FBAV/440.0]",
     "Facebook", "iOS"),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Googlebot",
     "Other"),
    ("curl/8.4.0", "curl", "Other"),
    ("python-requests/2.31.0", "Python Requests", "Other"),
    ("Mozilla/5.0 (X11; FreeBSD amd64; rv:120.0) Gecko/20100101 Firefox/120.0", "Firefox",
     "FreeBSD"),
    ("something else", "Other", "Other"),
    ("", "unknown", "unknown"),
    (None, "unknown", "unknown"),
]


@pytest.mark.parametrize("size", [64 << 20, 0])
def test_agents(spark, staging, size):
    rows = [(n % len(AGENTS), AGENTS[n % len(AGENTS)][0]) for n in range(3 * len(AGENTS))]
    df = spark.createDataFrame(rows, "system long, user_agent string").withColumn(
        "place", F.col("system"))
    got = with_families(df, staging, broadcast_bytes=size)
    assert got.columns == ["user_agent", "place", "browser", "system"]
    got = got.collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row.user_agent, row.browser, row.system) == AGENTS[row.place]


def test_families_of_no_rows_and_no_rules(spark, staging):
    none = spark.createDataFrame([], "user_agent string")
    assert with_families(none, staging).collect() == []
    some = spark.createDataFrame([("Chrome/1",), ("",), (None,)], "user_agent string")
    got = {tuple(r) for r in with_families(some, staging, rules=()).collect()}
    assert got == {("Chrome/1", "Other", "Other"), ("", "unknown", "unknown"),
                   (None, "unknown", "unknown")}


def test_rules_from_a_table(spark, staging, tmp_path):
    (tmp_path / "rules.json").write_text(
        '{"kind": "browser", "priority": 2, "family": "Plain", "token": "Kiosk/"}\n'
        '{"kind": "browser", "priority": 1, "family": "Tall", "token": "kiosk/", '
        '"beside": "Stand"}\n')
    rules = rules_of(spark.read.json(str(tmp_path), RULE_SCHEMA))
    df = spark.createDataFrame([("Kiosk/1 (stand 7)",), ("Kiosk/1",), ("kiosk",)],
                               "user_agent string")
    got = {r.user_agent: (r.browser, r.system)
           for r in with_families(df, staging, rules=rules).collect()}
    assert got == {"Kiosk/1 (stand 7)": ("Tall", "Other"), "Kiosk/1": ("Plain", "Other"),
                   "kiosk": ("Other", "Other")}
    many = spark.range(MAX_RULES + 1).select(
        F.lit(BROWSER).alias("kind"), F.lit(1).alias("priority"), F.lit("f").alias("family"),
        F.col("id").cast("string").alias("token"), F.lit(None).cast("string").alias("beside"))
    with pytest.raises(ValueError):
        rules_of(many)


@pytest.mark.parametrize("agent, tokens", [
    ("Mozilla/5.0 (Windows NT 10.0; Win64) Chrome/1 Mobile",
     {"mozilla/", "windows nt", "windows", "win64", "chrome/", "mobile"}),
    ("A/1 [B/2;C 3.0] (open (inner; D/4 x) rest", {"a/", "b/", "c", "open", "inner", "d/", "rest"}),
    ("((((", set()),
    ("", set()),
])
def test_agent_tokens(spark, agent, tokens):
    got, = one(spark, agent, agent_tokens("v"))
    assert set(got) == tokens and len(got) == len(tokens)


@pytest.mark.parametrize("unit", ["(", "x/", "(a;", "[x 1", " v", "a b;"])
def test_long_agents_take_time_in_proportion(spark, staging, unit):
    started = time.monotonic()
    text = unit * (400_000 // len(unit)) + " (x) Firefox/1"
    df = spark.createDataFrame([(text,)], "user_agent string")
    assert with_families(df, staging).first().browser == "Firefox"
    assert time.monotonic() - started < 30


def test_rules_name_each_family_once():
    families = {}
    for rule in RULES:
        assert rule == Rule(*rule) and rule.token == rule.token.lower()
        assert families.setdefault((rule.kind, rule.family), rule.priority) == rule.priority


def test_agents_stay_in_the_jvm(spark, staging, plan):
    df = with_families(spark.createDataFrame([("x",)], "user_agent string"), staging)
    assert "EvalPython" not in plan(df) and "PythonUDF" not in plan(df)
