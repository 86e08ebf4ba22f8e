"""Pages labelled by hand: y="1" marks main text, y="0" the rest; elements inherit their parent's.

Small stand-ins for the ways pages are built: semantic tags, layouts of named div elements, blogs with
comments, shops, documentation, forums, and pages with next to no markup.
"""

_P = "Several sentences of running text stand here, with commas, and they go on for a while. They end in full stops."
_Q = "A shorter paragraph follows, and it is part of the story too."

LABELLED = [
    f'<body y="0"><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul></nav><div class="ad">Buy now, the best offer of the year.</div><article y="1"><h1>A headline</h1><p>{_P}</p><p>{_Q}</p><p>{_P}</p></article><footer>&copy; 2024 Example &middot; All rights reserved.</footer></body>',
    f'<body y="0"><header><h1>Site name</h1><a href="/">Start</a></header><main y="1"><h2>Title of the page</h2><p>{_P}</p><ul><li>First point of the list, in full words.</li><li>Second point of the list, in full words.</li></ul><blockquote>{_Q}</blockquote></main><aside><h3>Popular</h3><ul><li><a href="/1">One story</a></li><li><a href="/2">Other story</a></li></ul></aside><footer><p>Imprint, privacy and terms.</p></footer></body>',
    f'<body y="0"><div id="header">My site</div><div id="menu"><a href="/a">A</a> <a href="/b">B</a></div><div id="content" y="1"><h1>Long read</h1><p>{_P}</p><p>{_P}</p><div class="share" y="0"><a href="/t">Share</a> <a href="/f">Like</a></div><p>{_Q}</p></div><div id="sidebar"><p>Subscribe to our letter for news and offers.</p></div><div id="footer">Contact us by mail. All rights reserved.</div></body>',
    f'<body y="0"><div class="cookie-notice"><p>We use cookies to improve this site. Accept all or change settings.</p></div><div class="wrapper"><div class="post" y="1"><h2 class="post-title">Post</h2><div class="post-body"><p>{_P}</p><p>{_Q}</p><pre>code = 1</pre></div></div><section id="comments" class="comments"><h3>2 comments</h3><div class="comment"><p>Great post, I liked it very much, thanks for writing.</p></div><div class="comment"><p>I do not agree with the author at all, but fine.</p></div></section></div></body>',
    f'<body y="0"><header><nav><a href="/">Home</a></nav></header><article y="1"><header><h1>Inside header of the article</h1><p class="byline">By a writer of the paper</p></header><section><h2>Part one</h2><p>{_P}</p></section><section><h2>Part two</h2><p>{_P}</p><table><tr><th>Name</th><td>Value one</td></tr><tr><th>Other</th><td>Value two</td></tr></table></section><aside class="related" y="0"><ul><li><a href="/x">More of this</a></li></ul></aside></article><form action="/s"><label>Search the site</label><p>Type your words here and press enter.</p></form><footer>Footer text</footer></body>',
    f'<body><p y="1">{_P}</p><p y="1">{_Q}</p><p y="1">{_P}</p></body>',
    f'<body y="0"><div class="banner advert"><p>Sale! Everything must go, only today, with free delivery to your door.</p></div><div class="main-text story" y="1"><p>{_Q}</p><p>{_P}</p><p>Short line.</p></div><div class="related-links"><ul><li><a href="/r">Read this next</a></li></ul></div><div class="newsletter"><form><p>Sign up for the newsletter, it is free and comes weekly.</p></form></div></body>',
    f'<body y="0"><div class="nav"><ul><li><a href="/q">Questions</a></li></ul></div><div class="entry-content article-body" y="1"><h1>An entry</h1><p>{_P}</p><h2>Section</h2><p>{_P}</p><ol><li>{_Q}</li><li>{_Q}</li></ol><dl><dt>Term</dt><dd>Meaning of the term.</dd></dl></div><div class="comments-list"><ul><li>First! I was here before all others, hello to everyone.</li></ul></div><div class="popup modal notice"><p>Please log in to go on reading, or make an account, it takes a minute.</p></div></body>',
    f'<body y="0"><nav class="breadcrumb"><a href="/">Home</a> / <a href="/d">Docs</a></nav><main y="1"><article><h1>Guide</h1><p>{_P}</p><p>{_P}</p><figure><figcaption>A caption of the picture.</figcaption></figure></article></main><div class="promo sponsored"><p>Our sponsors offer a discount for readers of this page.</p></div><section class="comments reader-comments"><article class="comment"><p>{_Q}</p></article><article class="comment"><p>{_P}</p></article></section><aside class="sidebar widget"><p>{_Q}</p></aside></body>',
    f'<body y="0"><div class="ad">And this is an offer.</div><article y="1"><h1>Title</h1><p>{_Q}</p><p>Ning.</p><p>Two words.</p><p>{_P}</p></article><footer>&copy; example &middot; words and words. More words, here.</footer></body>',
    f'<body y="0"><header class="site-header"><h1>The Site</h1><p>A tagline of the whole site, in a sentence.</p></header><div y="1"><h1>Story</h1><p>{_P}</p><form y="0"><p>Leave your mail address and we write to you, once a week.</p></form><p>{_Q}</p></div><section id="comments"><article class="comment"><p>{_P}</p></article><article class="comment"><p>{_Q}</p></article></section></body>',
    f'<body y="0"><header><h1>Name</h1></header><nav><a href="/1">One</a></nav><div y="1"><div><p>{_P}</p><p>{_Q}</p></div><div><p>{_Q}</p></div></div><div class="comments"><div class="comment"><p>{_P}</p></div><div class="comment"><p>{_Q}</p></div></div><form><p>{_Q}</p><label>Your mail</label></form></body>',
    f'<body y="0"><article y="1"><header><h1>Heading</h1></header><p>{_P}</p><aside y="0"><p>{_Q}</p></aside><form y="0"><p>{_Q}</p><p>Send</p></form><div class="ad" y="0"><p>{_Q}</p></div><p>{_P}</p><footer y="0"><p>Filed under things.</p></footer></article><section class="comments"><h2>Comments</h2><article><p>{_Q}</p></article><article><p>{_P}</p></article></section></body>',
    f'<body y="0"><div><nav><ul><li><a href="/z">Zed</a></li></ul></nav><div y="1"><h2>Notes</h2><p>{_Q}</p><ul><li>{_Q}</li></ul></div></div><div class="notice"><p>{_Q}</p></div><aside><div><p>{_P}</p></div></aside><footer><div><p>{_Q}</p></div></footer></body>',
    f'<body><div y="1"><p>{_P}</p></div><nav y="0"><a href="/k">Kay</a></nav><div y="1"><p>{_Q}</p></div><form y="0"><div><p>{_Q}</p></div></form></body>',
]
