import random

import pytest

from tickfold.llm import langid

LANGUAGES = {"en": "the and of that with this from there", "de": "der und nicht eine mit für auch über", "fr": "les des une dans avec pour être déjà"}


def text(lang, n, seed):
    return " ".join(random.Random(seed).choices(LANGUAGES[lang].split(), k=n))


@pytest.fixture(scope="module")
def trained(spark):
    return spark.createDataFrame([(x, text(x, 200, i)) for i, x in enumerate([*LANGUAGES] * 4)] + [(None, "x"), ("en", None)], "lang string, text string")


PAGES = "page_id long, url string, html string"


def page(lang, body, declared=None):
    return f"<html{f' lang={chr(34)}{declared}{chr(34)}' if declared else ''}><script>var der='und nicht'</script><nav>der die das</nav><article><p>{body}</p></article></html>"


@pytest.mark.parametrize(
    ("url", "parts"),
    [
        ("https://M.Shop.Example.com:80/fr/x?y", ("m.shop.example.com", "example.com", "com", "fr")),
        ("http://user@host.de", ("host.de", "host.de", "de", "")),
        ("//cdn.x.org/de-AT/", ("cdn.x.org", "x.org", "org", "de")),
        ("not an address", ("", "", "", "")),
        ("", ("", "", "", "")),
    ],
)
def test_address(url, parts):
    assert langid.address(url) == parts


def test_page_text():
    assert langid.page_text(page("en", "caf&eacute; <b>now</b>")).split() == ["café", "now"]
    assert langid.page_text("plain &lt;text&gt;") == "plain <text>"


def test_evidence_is_fused(spark, trained):
    rows = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, f"http://{lang}.example.com/{lang}/{i}", page(lang, text(lang, 30, i), lang)))
    rows += [
        (100, "http://de.example.com/de/x", page("de", "", "de")),  # no text: address, markup and host decide
        (101, "http://elsewhere.net/", page("fr", "", "fr")),  # markup alone
        (102, "http://en.example.com/en/", page("de", text("de", 40, 5), "en")),  # a long text outweighs wrong signs
        (103, "http://de.example.com/", page("de", "")),  # host alone
    ]
    got = {r.page_id: r for r in langid.identify(spark.createDataFrame(rows, PAGES), trained).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang == ("en", "de", "fr")[i % 3] for i in range(60))
    assert (got[100].lang, got[101].lang, got[102].lang, got[103].lang) == ("de", "fr", "de", "de")
    assert 0.3 < got[103].posterior < got[100].posterior <= 1


def test_declared_language_wherever_the_tag_stands():
    assert langid.declared("<!-- " + "x " * 9000 + "-->\n<HTML class=a\nLANG = 'De-at'>") == "de"
    assert langid.declared("<html><html dir=ltr><html lang=fr>") == "fr"
    assert langid.declared("<html lang=" + "<html " * 50_000) == "" and langid.declared("lang=en") == ""


def test_posteriors_equal_brute_force(spark, trained):
    """Short and mixed texts, where the signs decide, against the same fusion in plain Python."""
    import math
    from collections import defaultdict

    draw, rows = random.Random(4), []
    for i in range(120):
        lang = draw.choice(["en", "de", "fr"])
        body = " ".join([text(lang, draw.choice([0, 1, 2, 6]), i), text(draw.choice(["en", "de"]), draw.choice([0, 1, 3]), i + 500)])
        url = draw.choice([f"http://{lang}.example.com/{lang}/{i}", f"http://shop.{lang}-site.net/", f"http://site.{lang}/x", None])
        rows.append((i, url, page(lang, body, draw.choice([lang, "en", None]))))
    names, table = langid.profiles(trained)
    logs, shares, signs = [], [], []
    for _, url, html in rows:
        at = langid.trigrams(langid.page_text(html))
        log = table.astype("float32")[:, at].sum(1, dtype=float) * min(1.0, langid.INDEPENDENT / max(len(at), 1)) if len(at) else table[:, 0] * 0
        host, domain, suffix, folder = langid.address(url or "")
        logs.append(log)
        shares.append(langid.posterior(log))
        signs.append({"host": host, "domain": domain, "suffix": suffix, "folder": folder, "declared": langid.declared(html)})
    n, total = len(names), sum(shares)
    overall = [(total[k] + 1) / (total.sum() + n) for k in range(n)]
    sums = {key: defaultdict(lambda: [0.0] * n) for key in signs[0]}
    for sign, share in zip(signs, shares):
        for key, value in sign.items():
            sums[key][value] = [a + b for a, b in zip(sums[key][value], share)]
    got = {r.page_id: r for r in langid.identify(spark.createDataFrame(rows, PAGES), trained).collect()}
    changed = 0
    for i, (sign, share, log) in enumerate(zip(signs, shares, logs)):
        prior = overall
        for key in ("domain", "host"):
            own = [max(s - o, 0.0) for s, o in zip(sums[key][sign[key]], share)]
            prior = [(x + langid.PARENT * p) / (sum(own) + langid.PARENT) for x, p in zip(own, prior)]
        fused = [log[k] + math.log(prior[k]) for k in range(n)]
        for key in ("declared", "suffix", "folder"):
            if sign[key]:
                held = sums[key][sign[key]]
                of_all = max(sum(held) - 1, 0.0) / max(total.sum() - 1, 1.0)
                for k in range(n):
                    likely = (max(held[k] - share[k], 0.0) + langid.SIGN * of_all + 1e-9) / (max(total[k] - share[k], 0.0) + langid.SIGN)
                    fused[k] += math.log(likely)
        best = max(range(n), key=lambda k: (round(fused[k], 9), -k))
        assert got[i].lang == names[best]
        assert got[i].posterior == pytest.approx(1 / sum(math.exp(f - fused[best]) for f in fused), rel=1e-4)
        changed += got[i].lang != got[i].text_lang
    assert changed > 5


def test_odd_rows(spark, trained):
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "http://x.de/", "<html lang="), (3, "http://x.de/", page("de", text("de", 60_000, 1)))]
    pages = spark.createDataFrame([(*r, "extra", "z") for r in rows], PAGES + ", host string, lang string")
    out = langid.identify(pages, trained).collect()
    assert len(out) == 5 and next(r for r in out if r.page_id == 3).lang == "de"
    assert langid.identify(pages.limit(0), trained).count() == 0
    untrained = langid.identify(pages, trained.limit(0)).collect()
    assert len(untrained) == 5 and {r.lang for r in untrained} == {None}
