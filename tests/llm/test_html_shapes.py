"""Pages of many shapes, written by hand and apart from the grammar that trains the model."""

import pytest

from locuslens.llm import html

A = "The river rose again in the night, and by morning the lower fields were under water."
B = "Farmers moved their animals to the hill while neighbours carried furniture upstairs."
C = "Nobody was hurt, the mayor said on Tuesday, but two bridges will stay closed for weeks."
D = "Engineers expect that repairs to the dam cost more than the town can pay."
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/sport'>Sport</a></li></ul></nav>"
FOOT = "<footer><p>&copy; 2024 Valley Gazette. All rights reserved.</p><a href='/imprint'>Imprint</a></footer>"
ASIDE = "<aside class='sidebar'><h3>Most read</h3><ul><li><a href='/1'>Snow in May</a></li><li><a href='/2'>A new school</a></li></ul></aside>"
COOKIE = "<div id='cookie-banner'><p>We use cookies to make this site better for you.</p><button>Accept</button></div>"

PAGES = {
    "paragraphs straight in the body": (f"<html><body><p>{A}</p><p>{B}</p></body></html>", f"{A} {B}"),
    "paragraphs and a heading straight in the body": (f"<body><h1>Flood in the valley</h1><p>{A}<p>{B}<p>{C}</body>", f"Flood in the valley {A} {B} {C}"),
    "grid of plain containers": (f"<body><div class='container'><div class='row'><div class='col'><p>{A}</p><p>{B}</p></div></div></div></body>", f"{A} {B}"),
    "text in nested plain divs": (f"<body><div><div><div>{A}</div><div>{B}</div></div></div></body>", f"{A} {B}"),
    "plain containers between menu and footer": (f"<body>{NAV}<div><div><h1>Flood</h1><p>{A}</p><p>{B}</p><p>{C}</p></div></div>{FOOT}</body>", f"Flood {A} {B} {C}"),
    "bare body between menu and footer": (f"<body>{NAV}<h1>Flood</h1><p>{A}</p><p>{B}</p><p>{C}</p>{FOOT}</body>", f"Flood {A} {B} {C}"),
    "one short paragraph": ("<article><p>Tom and Jerry went home.</p></article>", "Tom and Jerry went home."),
    "a reference in a short paragraph": ("<article><p>Tom &amp; Jerry went home &mdash; late.</p></article>", "Tom & Jerry went home — late."),
    "one short paragraph in a whole page": (f"<body>{NAV}<article><h1>Short</h1><p>School is closed today.</p></article>{ASIDE}{FOOT}</body>", "Short School is closed today."),
    "names that hold other words": (f"<body><article class='post'><h1>Shares</h1><p class='share-price'>{A}</p><section class='related-work'><h2>Earlier studies</h2><p>{B}</p></section><p class='warning'>{C}</p></article></body>", f"Shares {A} Earlier studies {B} {C}"),
    "a paragraph about prices alone": (f"<body><article><h1>Market</h1><p class='share-price'>{A}</p><p>{B}</p></article></body>", f"Market {A} {B}"),
    "a warning inside the text": (f"<body>{NAV}<main><h1>Hiking</h1><p>{A}</p><p class='warning'>{D}</p><p>{B}</p></main>{FOOT}</body>", f"Hiking {A} {D} {B}"),
    "linked list items": (f"<body>{NAV}<article><h1>Walks</h1><p>{A}</p><ul><li><a href='/a'>Along the old mill</a></li><li><a href='/b'>Round the lake</a></li></ul><p>{B}</p></article>{FOOT}</body>", f"Walks {A} Along the old mill Round the lake {B}"),
    "plain list items": (f"<body><article><h1>Recipe</h1><ul><li>Two eggs</li><li>A cup of flour</li></ul><p>{A}</p></article></body>", f"Recipe Two eggs A cup of flour {A}"),
    "comments under a plain heading": (f"<body><article><h1>Flood</h1><p>{A}</p><p>{B}</p></article><section><h3>Comments</h3><div class='comment'><p>I saw it from my window, it was frightening.</p></div><div class='comment'><p>Same here.</p></div></section></body>", f"Flood {A} {B}"),
    "comments with a count": (f"<body><article><h1>Flood</h1><p>{A}</p><p>{B}</p></article><div id='comments'><h2>12 Comments</h2><ol><li class='comment'>Thank you for this report.</li></ol></div></body>", f"Flood {A} {B}"),
    "cookie notice first": (f"<body>{COOKIE}{NAV}<article><h1>Flood</h1><p>{A}</p><p>{B}</p></article>{FOOT}</body>", f"Flood {A} {B}"),
    "advert between paragraphs": (f"<body><article><h1>Flood</h1><p>{A}</p><div class='ad'>Buy rubber boots now and save half.</div><p>{B}</p></article></body>", f"Flood {A} {B}"),
    "sidebar inside main": (f"<body>{NAV}<main><article><h1>Flood</h1><p>{A}</p><p>{B}</p></article>{ASIDE}</main>{FOOT}</body>", f"Flood {A} {B}"),
    "camel-case names": (f"<body><div class='siteHeader'><a href='/'>Valley Gazette</a></div><div class='mainContent'><h1>Flood</h1><p>{A}</p><p>{B}</p></div><div class='siteFooter'>Valley Gazette, Mill Lane 3</div></body>", f"Flood {A} {B}"),
    "article without a heading": (f"<body>{NAV}<article><p>{A}</p><p>{B}</p></article>{FOOT}</body>", f"{A} {B}"),
    "table of figures": (f"<body><article><h1>Levels</h1><p>{A}</p><table><tr><th>Town</th><th>Metres</th></tr><tr><td>Mill</td><td>4.2</td></tr></table><p>{B}</p></article></body>", f"Levels {A} Town Metres Mill 4.2 {B}"),
    "quotation": (f"<body><article><h1>Flood</h1><p>{A}</p><blockquote><p>{C}</p></blockquote><p>{B}</p></article></body>", f"Flood {A} {C} {B}"),
    "headings between": (f"<body>{NAV}<article><h1>Flood</h1><p>{A}</p><h2>What comes next</h2><p>{B}</p><h2>The dam</h2><p>{D}</p></article>{FOOT}</body>", f"Flood {A} What comes next {B} The dam {D}"),
    "search form and newsletter": (f"<body><form class='search'><label>Search</label><input name='q'></form><article><h1>Flood</h1><p>{A}</p><p>{B}</p></article><div class='newsletter'><p>Get our letter every Friday.</p></div></body>", f"Flood {A} {B}"),
    "scripts and styles": (f"<head><style>p {{ color: red }}</style></head><body><article><h1>Flood</h1><p>{A}</p><script>var x = '<p>no</p>';</script><p>{B}</p></article></body>", f"Flood {A} {B}"),
    "a menu alone": (f"<body>{NAV}{FOOT}</body>", ""),
}


@pytest.fixture(scope="module")
def model():
    return html.fit()


@pytest.mark.parametrize("name", PAGES)
def test_main_text(model, name):
    source, want = PAGES[name]
    assert html.main_text(source, model) == want


def test_names_are_read_whole():
    assert html.name_groups("share-price") == {"part:form"} and html.name_groups("related-box sidebar") == {"word:side"}
    assert html.name_groups("siteFooter") == {"word:frame"} and html.name_groups("x1 lead") == set() and html.name_groups("") == set()
