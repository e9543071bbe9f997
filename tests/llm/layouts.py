"""Hand-written pages and their main texts: layouts that the generator does not make."""

LEFT = "<header class='site-header'><div class='logo'><a href='/'>The Daily Sample</a></div><nav><ul><li><a href='/w'>World</a></li><li><a href='/s'>Sport</a></li></ul></nav></header>"
FOOT = "<footer><p>&copy; 2024 The Daily Sample</p><ul><li><a href='/privacy'>Privacy</a></li><li><a href='/imprint'>Imprint</a></li></ul></footer>"
P1 = "The council met on Tuesday to discuss the new bridge across the river."
P2 = "Members were told that the work would take three years, and that no tolls were planned."
P3 = "A vote is expected before the end of the month."

#: (name, html, text)
LAYOUTS = [
    ("list with links", f"<body>{LEFT}<article><header><h1>Bridge plans</h1><p>By Ann Lee</p></header><p>{P1}</p><blockquote>{P2}</blockquote>"
     f"<ul><li><a href='/1'>First linked item of the article</a></li><li>Second</li></ul><aside><h3>Related</h3><p><a href='/x'>Other story</a></p></aside></article>{FOOT}</body>",
     f"Bridge plans By Ann Lee {P1} {P2} First linked item of the article Second"),
    ("details", f"<body>{LEFT}<main><article><h1>Questions about the bridge</h1><p>{P1}</p><details><summary>More</summary><p>{P2}</p></details><p>{P3}</p></article></main>{FOOT}</body>",
     f"Questions about the bridge {P1} More {P2} {P3}"),
    ("definition list", f"<body>{LEFT}<div id='content'><h1>Terms used</h1><dl><dt>Abutment</dt><dd>{P1}</dd><dt>Deck</dt><dd>{P2}</dd></dl></div>{FOOT}</body>",
     f"Terms used Abutment {P1} Deck {P2}"),
    ("table in article", f"<body>{LEFT}<article><h1>Costs by year</h1><p>{P1}</p><table><tr><th>Year</th><th>Cost</th></tr><tr><td>2024</td><td>12 million</td></tr>"
     f"<tr><td>2025</td><td>19 million</td></tr></table><p>{P2}</p></article>{FOOT}</body>",
     f"Costs by year {P1} Year Cost 2024 12 million 2025 19 million {P2}"),
    ("figure", f"<body>{LEFT}<article><h1>View of the river</h1><figure><img src='a.jpg'><figcaption>The river in spring, seen from the old pier.</figcaption></figure><p>{P1}</p><p>{P2}</p></article>{FOOT}</body>",
     f"View of the river The river in spring, seen from the old pier. {P1} {P2}"),
    ("section tags only", f"<body>{LEFT}<main><section><h1>Report</h1><p>{P1}</p></section><section><h2>Details</h2><p>{P2}</p><p>{P3}</p></section></main>{FOOT}</body>",
     f"Report {P1} Details {P2} {P3}"),
    ("wrapped twice", f"<body><div class='page'><div class='container'>{LEFT}<div class='post-content'><h1>Bridge news</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div></div>{FOOT}</div></body>",
     f"Bridge news {P1} {P2} {P3}"),
    ("numbered steps", f"<body>{LEFT}<article><h1>How to cross</h1><ol><li>{P1}</li><li>{P2}</li><li>{P3}</li></ol></article>{FOOT}</body>",
     f"How to cross {P1} {P2} {P3}"),
    ("nested list", f"<body>{LEFT}<article><h1>Plan</h1><p>{P1}</p><ul><li>Foundations<ul><li>North bank</li><li>South bank</li></ul></li><li>Deck</li></ul><p>{P3}</p></article>{FOOT}</body>",
     f"Plan {P1} Foundations North bank South bank Deck {P3}"),
    ("code", f"<body>{LEFT}<article><h1>Reading the gauge</h1><p>{P1}</p><pre><code>level = read(gauge)\nprint(level)</code></pre><p>{P2}</p></article>{FOOT}</body>",
     f"Reading the gauge {P1} level = read(gauge) print(level) {P2}"),
    ("cookie notice and newsletter", f"<body><div id='cookie-banner'><p>We use cookies on this site.</p><button>Accept all</button></div>{LEFT}<article><h1>Bridge</h1><p>{P1}</p>"
     f"<div class='newsletter-form'><form><label>Email</label><input><button>Subscribe</button></form></div><p>{P2}</p></article>{FOOT}</body>", f"Bridge {P1} {P2}"),
    ("comments", f"<body>{LEFT}<article><h1>Bridge</h1><p>{P1}</p><p>{P2}</p></article><section class='comments'><h2>2 comments</h2><div class='comment'><p>I like this bridge very much.</p></div>"
     f"<div class='comment'><p>So do I, but it costs a lot of money.</p></div></section>{FOOT}</body>", f"Bridge {P1} {P2}"),
    ("sidebar first", f"<body>{LEFT}<aside class='sidebar'><h3>Popular</h3><ul><li><a href='/1'>Old mill sold</a></li><li><a href='/2'>Rain all week</a></li></ul></aside>"
     f"<article><h1>Bridge</h1><p>{P1}</p><p>{P2}</p></article>{FOOT}</body>", f"Bridge {P1} {P2}"),
    ("advert between", f"<body>{LEFT}<article><h1>Bridge</h1><p>{P1}</p><div class='ad-slot'><p>Advertisement</p><a href='/buy'>Buy now</a></div><p>{P2}</p><p>{P3}</p></article>{FOOT}</body>",
     f"Bridge {P1} {P2} {P3}"),
    ("breadcrumb", f"<body>{LEFT}<nav class='breadcrumb'><a href='/'>Home</a> <a href='/local'>Local</a></nav><main><h1>Bridge</h1><p>{P1}</p><p>{P2}</p></main>{FOOT}</body>", f"Bridge {P1} {P2}"),
    ("unclosed paragraphs", f"<body>{LEFT}<article><h1>Bridge</h1><p>{P1}<p>{P2}<p>{P3}</article>{FOOT}</body>", f"Bridge {P1} {P2} {P3}"),
    ("byline and date", f"<body>{LEFT}<article><header><h1>Bridge</h1><p>By Tom Ray</p><p>Published 3 May 2024</p></header><p>{P1}</p><p>{P2}</p></article>{FOOT}</body>",
     f"Bridge By Tom Ray Published 3 May 2024 {P1} {P2}"),
    ("inline markup", f"<body>{LEFT}<article><h1>The <em>new</em> bridge</h1><p>The <strong>council</strong> met, and <a href='/c'>its members</a> spoke&nbsp;&mdash; at length.</p><p>{P2}</p></article>{FOOT}</body>",
     f"The new bridge The council met, and its members spoke — at length. {P2}"),
    ("share buttons", f"<body>{LEFT}<article><h1>Bridge</h1><p>{P1}</p><div class='social-share'><a href='#'>Share</a> <a href='#'>Tweet</a></div><p>{P2}</p></article>{FOOT}</body>", f"Bridge {P1} {P2}"),
    ("quotations with paragraphs", f"<body>{LEFT}<article><h1>Voices</h1><blockquote><p>{P1}</p><p>{P2}</p></blockquote><p>{P3}</p></article>{FOOT}</body>", f"Voices {P1} {P2} {P3}"),
    ("headings of several levels", f"<body>{LEFT}<article><h1>Guide</h1><h2>Before</h2><p>{P1}</p><h3>Papers</h3><p>{P2}</p><h2>After</h2><p>{P3}</p></article>{FOOT}</body>",
     f"Guide Before {P1} Papers {P2} After {P3}"),
    ("related list after the article", f"<body>{LEFT}<article><h1>Bridge</h1><p>{P1}</p><ul><li><a href='/a'>Minutes of the meeting</a></li><li><a href='/b'>Map of the site</a></li></ul></article>"
     f"<div class='related-posts'><h3>You may also like</h3><ul><li><a href='/c'>Ferry stops running</a></li></ul></div>{FOOT}</body>",
     f"Bridge {P1} Minutes of the meeting Map of the site"),
]
