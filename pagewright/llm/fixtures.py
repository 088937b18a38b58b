"""Fixed pages and their main texts: pages without an article, with several, with misleading class names, and broken ones."""

_LONG = "This is a long paragraph of real text, which goes on for quite a while and says a lot of things about its matter."
_NAV = "<nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>"
_FOOT = "<footer>&copy; a company &middot; and what it has to say about its rights, at length</footer>"

MAIN_TEXT: list[tuple[str | None, str]] = [
    (None, ""),
    ("", ""),
    (f"<body>{_NAV}<article><p>{_LONG}</p><p>Sh.</p></article><article><h2>B</h2><p>{_LONG} Two</p></article>{_FOOT}</body>", f"{_LONG} Sh. B {_LONG} Two"),
    (f"<body>{_NAV}<div class='search-results'><h1>Found</h1><p>{_LONG}</p><p>Short.</p><p>{_LONG}</p></div>{_FOOT}</body>", f"Found {_LONG} Short. {_LONG}"),
    (f"<body>{_NAV}<div class='related-work'><p>{_LONG}</p><p>Short.</p><p>{_LONG}</p></div>{_FOOT}</body>", f"{_LONG} Short. {_LONG}"),
    (f"<article><p>{_LONG}</p><section class='related-work'><p>{_LONG}</p><p>{_LONG}</p></section></article>{_FOOT}", f"{_LONG} {_LONG} {_LONG}"),
    (f"<article><p>{_LONG}</p><p class=ad>Buy<br>now!</p><p>{_LONG}</p></article>", f"{_LONG} {_LONG}"),
    (f"<body class='has-sidebar'><main class='site-main has-sidebar'><h1>T</h1><div><p>{_LONG}</p><p>x</p></div></main>{_FOOT}</body>", f"T {_LONG} x"),
    (f"<article><p>{_LONG}</p><div id=comments><p>{_LONG}{_LONG}</p><p>{_LONG}</p></div></article>", _LONG),
    (f"<form>{_NAV}<div><h1>Head</h1><p>{_LONG}</p><p>no</p></div><label>Name</label><input></form>{_FOOT}", f"Head {_LONG} no"),
    (f"<div>{_LONG}</div><div>short div</div><div>{_LONG}</div>", f"{_LONG} short div {_LONG}"),
    (f"<p>foo<span class=share>x</span>bar {_LONG}</p>", f"foobar {_LONG}"),
    (f"{_NAV}<table><tr><td><a href=1>one</a><td><p>{_LONG}<p>{_LONG}</td></table>{_FOOT}", f"{_LONG} {_LONG}"),
    ("just\n text &amp; more", "just text & more"),
    (f"<article><header><h1>Title</h1></header><p>{_LONG}</p><aside>see also</aside><ul><li>one<li>two</ul></article>", f"Title {_LONG} one two"),
]
