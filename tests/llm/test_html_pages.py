"""Main text of hand-made pages: wrappers, headers, forms, comments, broken and very deep markup."""

from __future__ import annotations

import time

import pytest

from inkwell.llm import html_text

PROSE = "The quick fox of the forest was in the garden and it stood on the hill with a bird that had been there for years. " * 3
TEXT = " ".join(PROSE.split())
P = f"<p>{PROSE}</p>"
RUSSIAN = " ".join(("Вчера вечером жители города собрались на площади, чтобы послушать музыку и поговорить о новостях. " * 4).split())
GREEK = " ".join(("Χθες το βράδυ οι κάτοικοι της πόλης μαζεύτηκαν στην πλατεία για να ακούσουν μουσική και να μιλήσουν. " * 3).split())
JAPANESE = "昨日の夜、町の人々は広場に集まり、音楽を聴きながら新しい出来事について話し合いました。" * 4
POLISH = " ".join(("Wczoraj wieczorem mieszkańcy miasta zebrali się przed ratuszem, żeby słuchać muzyki oraz rozmawiać wspólnie. " * 4).split())
MENU = "<ul>" + "".join(f'<li><a href="/{k}">Entry {k}</a></li>' for k in range(6)) + "</ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div class="page no-sidebar">{P}</div>', TEXT),
        (f'<main class="with-sidebar">{P}</main>', TEXT),
        (f'<div class="layout-sidebar-right"><div class="content">{P}</div></div>', TEXT),
        (f'<div class="single comments-open"><main>{P}</main></div>', TEXT),
        (f'<article><header class="entry-header"><h1>A title</h1></header>{P}</article>', "A title\n" + TEXT),
        (f"<form action=x>{MENU}<article>{P}</article><label>Name</label><input><button>Go</button></form>", TEXT),
        (f"<article>{P}</article><form><p>Your name and the town of your birth, please, for the list of the readers of this page here.</p><select><option>a</select></form>", TEXT),
        (f'<article>{P}</article><div class="comments"><article>{P}</article><article>{P}</article></div>', TEXT),
        (f'<div class="sidebar">{P}</div><main>{P}{P}</main>', TEXT + "\n" + TEXT),
        (f'<header class="site-header"><a href="/">Site</a></header><nav>{MENU}</nav><article>{P}</article><footer>&copy; all</footer>', TEXT),
        (f'<div class="cookie-notice">We use cookies of this site and of the others, as it is in the law of the land.</div><article>{P}</article>', TEXT),
        (f"<div title=\"{'y > z ' * 3000}\">{P}</div>", TEXT),
        (f"<p title='a \" b'>{PROSE}</p>", TEXT),
        (f"<svg><text>x</text></svg><button>unclosed {P}", "unclosed\n" + TEXT),
        (f"<!-- a > b --><!--><script>if (a<b) '</p>'</script><style>p>a{{}}</style>{P}<!-- open {P}", TEXT),
        (f"<p>{RUSSIAN}</p><nav>{MENU}</nav><p>{RUSSIAN}</p><p><a href=/x>{RUSSIAN}</a></p>", RUSSIAN + "\n" + RUSSIAN),
        (f"<div>{JAPANESE}</div><div>{JAPANESE[:50]}</div><div>目次</div><footer>{JAPANESE}</footer>", JAPANESE + "\n" + JAPANESE[:50] + "\n目次"),
        (f"<nav>{MENU}</nav><div>{GREEK}</div><div class=ad>{GREEK}</div>", GREEK),
        (f"<div>{POLISH}</div><div>{POLISH}</div>", POLISH + "\n" + POLISH),
        (f"<p>{PROSE}</p><div>{'SKU-1 42 17.50 ' * 20}</div><p>{PROSE}</p>", TEXT + "\n" + TEXT),
        (f"<article>{P}<ul><li><a href=/a>Anna Smith</a> as Eve</li><li><a href=/b>Bob Jones</a></li></ul><p>Photo © The town</p>{P}</article>", f"{TEXT}\nAnna Smith as Eve\nBob Jones\nPhoto © The town\n{TEXT}"),
        (f"<article>{P}<ul><li><a href=/a>Anna Smith</a></li></ul><div class=share>Share</div><p>© The town</p>{P}</article>", TEXT + "\n" + TEXT),
        (f"{P}<p>See the <a href=/p>{' ' * 400}plan{' ' * 400}</a> for all of the details of it.</p>{P}", f"{TEXT}\nSee the plan for all of the details of it.\n{TEXT}"),
        (f"<a href=/t><div><h3>A teaser</h3><p>{PROSE}</p></div></a><div>{P}</div><a href=/u><div><p>{PROSE}</p></div></a>", TEXT),
        (f"<a href=/t>unclosed<div>{P}</div><a name=x><div>{P}</div>", TEXT + "\n" + TEXT),
        (f"<a name=top><div>{P}</div></a>", TEXT),
        ("a &lt;b&gt; &amp;amp; 1 < 2", ""),
        ("", ""),
        ("<p>", ""),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("piece", ["<div>x", '<a href="x >y', "<p class='a\" b>y", "<svg>", "</svg><svg>", "<b x=\"", "<!-", "</", "<div class=ad>", "<title>", "<textarea>x", "< "])
def test_broken_markup_takes_linear_time(piece):
    took = []
    for n in (25_000, 100_000):
        began = time.process_time()
        html_text.main_text(piece * n + "</svg>")
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", P, "x", 1), (1, "u", P, "x", 1), (2, None, None, None, None)], "page_id long, url string, html string, text string, n_chars int")
    rows = html_text.extract(pages).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in rows] == [(1, TEXT, len(TEXT))] * 2 + [(2, "", 0)]
