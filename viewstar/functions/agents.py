"""Product tokens of a user-agent string, and the rules that name a family by them.

A user agent is a list of products ``name/version`` and of comments in brackets, whose parts
stand between semicolons. ``agent_tokens`` parses it once into the names, in lower case; rules
are rows of data that name a browser or a system by one token, or by one token beside another.
A product's name ends in ``/``, so a plain word never passes for a product. A text that no rule knows is "Other", as user-agent parsers call a family they do not know;
without any text the family is "unknown".
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "unknown"
OTHER = "Other"
BROWSER, SYSTEM = "browser", "system"
#: Rules are broadcast, so their number has a bound.
MAX_RULES = 65_536


class Rule(NamedTuple):
    """``family`` holds where ``token`` is found, and ``beside`` too unless it is None.

    Of several rules that hold, the one of least priority names the family.
    """

    kind: str
    priority: int
    family: str
    token: str
    beside: str | None = None


RULE_SCHEMA = "kind string, priority int, family string, token string, beside string"

# Family names and the tokens that products are known to send. The first line
# that holds names the family; "a+b" asks for both tokens.
_BROWSERS = """
Googlebot: googlebot/, googlebot-image/, googlebot-news/, googlebot-video/
AdsBot-Google: adsbot-google/, adsbot-google-mobile/
bingbot: bingbot/
YandexBot: yandexbot/
Baiduspider: baiduspider/
DuckDuckBot: duckduckbot/
Applebot: applebot/
AhrefsBot: ahrefsbot/
SemrushBot: semrushbot/
PetalBot: petalbot/
Facebook: fban/, fbav/
facebookexternalhit: facebookexternalhit/
Twitterbot: twitterbot/
LinkedInBot: linkedinbot/
Instagram: instagram, instagram/
Pinterest: pinterest/
Snapchat: snapchat/, snapchat
WeChat: micromessenger/
Line: line/
Samsung Internet: samsungbrowser/
UC Browser: ucbrowser/
QQ Browser Mobile: mqqbrowser/
QQ Browser: qqbrowser/
MiuiBrowser: miuibrowser/
HuaweiBrowser: huaweibrowser/
VivoBrowser: vivobrowser/
HeyTapBrowser: heytapbrowser/
Yandex Browser: yabrowser/
Coc Coc: coc_coc_browser/
Whale: whale/
Vivaldi: vivaldi/
Brave: brave/
DuckDuckGo: duckduckgo/, ddg/
Ecosia: ecosia/
Amazon Silk: silk/
Puffin: puffin/
Maxthon: maxthon/
Sogou Explorer: metasr
Epiphany: epiphany/
Konqueror: konqueror/
Falkon: falkon/
SeaMonkey: seamonkey/
Pale Moon: palemoon/
Waterfox: waterfox/
Thunderbird: thunderbird/
Electron: electron/
HeadlessChrome: headlesschrome/
PhantomJS: phantomjs/
Opera Mini: opera mini/, mini/+opera
Opera Touch: opt/
Opera Mobile: opr/+mobile
Opera: opr/, opera/
Edge Mobile: edga/, edgios/
Edge: edg/, edge/
Chrome Mobile iOS: crios/
Firefox iOS: fxios/
Firefox Focus: focus/, klar/
Firefox Mobile: firefox/+android, firefox/+mobile
Firefox: firefox/
Chrome Mobile WebView: chrome/+wv
Chrome Mobile: chrome/+mobile
Chromium: chromium/
Chrome: chrome/
BlackBerry WebKit: bb10+version/, blackberry+version/
Android: version/+android
Mobile Safari: version/+iphone, version/+ipad, version/+ipod
Safari: version/+safari/
IE Mobile: iemobile/, iemobile
IE: msie, trident/
Lynx: lynx/
ELinks: elinks/
w3m: w3m/
curl: curl/
Wget: wget/
Python Requests: python-requests/
Python-urllib: python-urllib/
aiohttp: aiohttp/
okhttp: okhttp/
Java: java/
Apache-HttpClient: apache-httpclient/
Go-http-client: go-http-client/
axios: axios/
node-fetch: node-fetch/
PostmanRuntime: postmanruntime/
"""
_SYSTEMS = """
Windows Phone: windows phone, windows phone os
Xbox: xbox, xbox one
Windows: windows, windows nt
HarmonyOS: harmonyos, openharmony
KaiOS: kaios/
Tizen: tizen
webOS: web0s, webos, hpwos
Android: android
tvOS: apple tv, tvos
iOS: iphone, ipad, ipod, ipod touch
Chrome OS: cros
BlackBerry OS: bb10, blackberry
Symbian OS: symbianos, symbos, symbian
PlayStation: playstation, playstation vita
Nintendo: nintendo, nintendo switch, nintendo wiiu
Mac OS X: macintosh, mac os x
Ubuntu: ubuntu
Fedora: fedora
Debian: debian
CentOS: centos
Red Hat: red hat
SUSE: suse
Gentoo: gentoo
Arch Linux: arch linux
FreeBSD: freebsd
OpenBSD: openbsd
NetBSD: netbsd
Solaris: sunos
Linux: linux, x11
"""


def _rules(kind: str, lines: str) -> list[Rule]:
    rules = []
    for priority, line in enumerate(lines.strip().splitlines()):
        family, tokens = line.split(": ", 1)
        for token in tokens.split(", "):
            first, _, beside = token.partition("+")
            rules.append(Rule(kind, priority, family, first, beside or None))
    return rules


RULES: tuple[Rule, ...] = (*_rules(BROWSER, _BROWSERS), *_rules(SYSTEM, _SYSTEMS))


def rules_of(table: DataFrame) -> tuple[Rule, ...]:
    """Rules kept in a table with the columns of ``Rule``; too many are an error."""
    rows = table.select(*Rule._fields).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return tuple(Rule(row.kind, int(row.priority), row.family, row.token.lower(),
                      row.beside and row.beside.lower()) for row in rows)


def known_tokens(rules: Sequence[Rule]) -> list[str]:
    return sorted({token for rule in rules for token in (rule.token, rule.beside) if token})


def agent_tokens(agent) -> Column:
    """Names in lower case, each once: words and products, parts of comments and their first
    words. Versions are cut off: ``Chrome/12.0`` is ``chrome/``, ``Windows NT 10.0`` is
    ``windows nt`` and ``windows``. Every pattern takes time in proportion to the text."""
    agent = F.col(agent) if isinstance(agent, str) else agent
    inside = F.regexp_extract_all(agent, F.lit(r"[(\[]([^()\[\]]*)[)\]]"), F.lit(1))
    outside = F.regexp_replace(agent, r"[(\[][^()\[\]]*[)\]]", " ")
    parts = F.transform(F.split(F.array_join(inside, ";"), ";"), lambda part: F.trim(part))
    words = F.concat(F.split(outside, r"[\s()\[\];]+"),
                     F.transform(parts, lambda part: F.split_part(part, F.lit(" "), F.lit(1))))
    names = F.transform(F.concat(words, parts), lambda part: F.lower(F.regexp_replace(
        part, r"(/)[\s\S]*$| v?[0-9][\s\S]*$", "$1")))
    return F.array_remove(F.array_distinct(names), "")
