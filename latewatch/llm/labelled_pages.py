"""Pages labelled by hand: elements marked with ``data-content`` hold main text, everything else does not.

The mark is read for labels only and is never a feature.
"""

PAGES = [
    """<html><head><title>Harbour reopens</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li>
    <li><a href=/s>Sport</a></li></ul></nav><div class="ad">Buy our boats today, the best offers on the coast.</div>
    <article data-content><h1>Harbour reopens</h1><p>The harbour reopened on Monday after two years of work on its outer wall, the port authority said.</p>
    <p>Ships of all sizes may now enter again.</p><p>Short.</p></article><footer>&copy; The Harbour Post. All rights reserved.</footer></body></html>""",
    """<body><header class="site-header"><a href=/>Daily</a><p>News from the valley since 1901.</p></header>
    <div id="cookie-notice"><p>We use cookies to improve this site. By reading on you accept them.</p><button>OK</button></div>
    <main><div class="post-content" data-content><h1>On growing beans</h1><p>Beans want a warm soil and a fence to climb on, and little else.</p>
    <ul><li>Sow them in May.</li><li>Water the rows once a week in dry months.</li></ul><blockquote>Plant what you like to eat.</blockquote>
    <p>They freeze well.</p></div><section id="comments" class="comments"><h3>Comments</h3><div class="comment"><p>I tried this last year and it worked very well for me, thank you for the advice.</p></div>
    <div class="comment"><p>Mine were eaten by slugs within a single night.</p></div></section></main>
    <aside class="sidebar"><h4>Popular</h4><ul><li><a href=1>Ten best roses for the shade</a></li><li><a href=2>Compost made simple</a></li></ul></aside>
    <footer><p>Contact us by post. Imprint and privacy.</p></footer></body>""",
    """<body><div class="menu"><a href=a>Start</a> <a href=b>Shop</a> <a href=c>About</a></div><div class="container"><div class="article-body" data-content>
    <h2>The quiet month</h2><p>February is the month in which nothing is announced and everything is prepared. <a href=x>Our earlier report</a> says why.</p>
    <table><tr><td>Rain</td><td>40 mm</td></tr><tr><td>Wind</td><td>moderate</td></tr></table><pre>a table of tides</pre></div>
    <div class="related"><h3>Related</h3><p><a href=r>Why the wind turns in March and what follows</a></p></div>
    <form action=/s><label>Your mail address</label><p>Sign up for the letter and never miss a story.</p></form></div><div class="footer"><p>All rights reserved.</p></div></body>""",
    """<body><div id="header"><h1>The Gazette</h1></div><div id="nav"><ul><li><a href=1>World</a><li><a href=2>Local</a></ul></div>
    <div id="content"><div class="entry" data-content><h1>A bridge too small</h1><p>The new bridge carries one lane only, which nobody had expected when the plan was drawn.</p><p><b>The mayor spoke.<br><p>There will be a second one, in time, if the money can be found somewhere.</div>
    <div class="share"><a href=t>Share</a> <a href=f>Send</a></div><div class="advert"><p>Cheap tyres, fitted while you wait, every day of the week.</p></div></div>
    <div id="sidebar"><p>Weather: cloudy with some sun in the later hours.</p></div><div id="footer">Imprint</div></body>""",
    """<body><section class="hero" role="banner"><p>Welcome to the museum of clocks, open every day.</p></section><article data-content><header><h1>How clocks were made</h1></header>
    <section><h2>Wheels</h2><p>Each wheel was cut by hand from brass sheet and filed until it ran true.</p></section><section><h2>Springs</h2><p>Springs came later.</p>
    <figure><figcaption>A spring of 1640.</figcaption></figure></section></article><div class="newsletter popup"><p>Subscribe now and receive our catalogue twice a year.</p></div>
    <nav role="navigation"><a href=1>1</a> <a href=2>2</a> <a href=3>Next page</a></nav><footer class="bottom"><ul><li><a href=i>Imprint</a></li></ul><p>Museum of clocks, 12 Tower Street.</p></footer></body>""",
    """<body><div class="top-bar"><span>Login</span></div><div role="main" data-content><h1>Minutes of the meeting</h1><p>Present were all members but one, who had sent a note.</p><dl><dt>Budget</dt><dd>Agreed as drafted.</dd></dl>
    <div>The chair closed the meeting at nine and thanked all who had come.</div></div><div class="disclaimer notice"><p>This page is for information only and is no legal advice.</p></div>
    <div class="reader-comments"><article class="comment"><p>Good to hear that the budget went through without a long debate.</p></article></div></body>""",
    """<body><ul class="breadcrumb"><li><a href=/>Home</a></li><li>Physics</li></ul><div class="wrapper"><article class="story" data-content><h1>Why ice floats</h1><p>Water grows as it freezes. The same weight then fills more room, and so it floats.</p><h2>Salt</h2><p>Sea ice holds little salt.</p><ol><li>Freeze.</li><li>Wait.</li></ol></article>
    <aside><p>Did you know that the deepest lake is in the east of the continent?</p></aside><div class="banner ads"><p>Learn physics at home with our new course, half price this week.</p></div></div><footer>&copy; Ice &middot; Some words that the owner of the site has put here.</footer></body>""",
    """<body><nav><ul><li><a href="/a">Alpha</a></li><li><a href="/b">Beta</a></li><li><a href="/c">Gamma</a></li></ul></nav><!-- ad 7 --><div class="ad">La rue est longue et le pain est chaud.</div><article data-content><h1>Short</h1><p><b>Short and cut.<br><p>One line.</p></article><footer>&copy; www.short.example &middot; Words of the day, as every day.</footer>""",
    """<body><header><nav><a href=1>One</a><a href=2>Two</a></nav></header><div class="page"><div data-content><p>A page without any article element has its text in plain blocks, and the length of the text is what tells.</p><p>It goes on for a second paragraph, with several sentences. They end in full stops. Nothing in it is a link.</p></div><div><a href=p>Previous</a> <a href=n>Next</a></div></div><div class="consent">This site stores small files on your device. <a href=x>More</a></div></body>""",
    """<body><div class="login form"><form><p>User name and password, please.</p></form></div><section class="content" data-content><h1>Notes on paper</h1><h2>Weight</h2><p>Paper is sold by weight per area.</p><p>Old paper is brittle, as the acid in it eats the fibres over the years.</p></section><section class="social"><p>Follow us on all channels for more of the same.</p></section><div hidden><p>This text is hidden from every reader of the page.</p></div><div class="promo sponsored"><h3>Sponsored</h3><p>The finest paper, sent to your door within two days.</p></div></body>""",
    """<body><nav><ul><li><a href="/u">Über</a></li><li><a href="/v">Verein</a></li></ul></nav><div class="ad">Then they came for the bread and left without it.</div><article data-content><h1>Der Verein im Winter und was er dort tut</h1><p><b>Der Verein im Winter trifft sich einmal in der Woche in einem kleinen Raum hinter der Kirche, in dem ein Ofen steht und ein Tisch, an dem acht Leute sitzen können, wenn sie wollen, und meistens wollen sie</p></article><footer>&copy; verein.example &middot; Der Rat und die Tat sind zwei Dinge.</footer></body>""",
    """<body><nav><ul><li><a href="/1">uno</a></li><li><a href="/2">dos</a></li><li><a href="/3">tres</a></li></ul></nav><div class="ad">The goods are out of the store by noon.</div><article data-content><h1>El pan de ayer</h1></article><footer>&copy; pan.example &middot; Lo que queda es poco.</footer></body>""",
    """<body><nav><a href="/1">un</a></nav><article data-content><h1>Le vent</h1><p>Le vent tourne vers midi. Les bateaux restent au port, et les gens attendent sur le quai en parlant du temps, de la mer et des enfants qui sont partis travailler dans la grande ville, loin de la côte et de ses habitudes.</p></article><div class="comments"><p>Merci pour ce bel article sur le vent.</p></div><footer>&copy; vent.example</footer></body>""",
    """<body><div class="ad">Kauf dir ein Boot.</div><article data-content><p>Nur ein Absatz</p></article><footer>Worte am Ende der Seite, die jeder überliest.</footer></body>""",
    """<body><ul class="menu"><li><a href=1>Start</a></li></ul><article class="post" data-content><h1>Notes</h1><p>First note, without any end</p><p><b>Second note<br></article><aside class="sidebar"><h3>Also read</h3><p>Other notes that other people wrote.</p></aside><footer>&copy; notes</footer>""",
    """<body><nav><a href=/>Home</a> <a href=/w>World</a></nav><article data-content><h1>Harbour dues rise</h1><p>The dues rise by a tenth in spring, the harbour board decided on Friday.</p>
    <p><a href=r>Read the full report of the harbour board with all its tables.</a></p><p>Ship owners had asked for a longer delay.</p><h2><a href=s>What the owners say</a></h2>
    <p>They fear for the small boats.</p><ul><li><a href=1>Letter of the owners to the board</a></li><li><a href=2>Answer of the board of last week</a></li></ul></article>
    <aside><ul><li><a href=3>Most read this week</a></li><li><a href=4>Ferry times for the summer</a></li></ul></aside><footer><a href=i>Imprint</a> <a href=p>Privacy</a></footer></body>""",
    """<body><div id=top><a href=/>Start</a> | <a href=/map>Map</a></div><div id=main data-content><h1>Sources on the old mill</h1><p>The list below names what has been printed on the mill.</p>
    <ol><li><a href=a>Records of the parish, second volume, 1780 to 1795</a></li><li><a href=b>A letter by the miller's widow</a></li><li><a href=c>Plan of the weir</a></li></ol>
    <p><a href=d>All of them can be read in the town archive.</a></p></div><div id=foot><p>Town archive, Mill Lane 3, open from ten to four.</p></div></body>""",
    """<body><header><h2>The Valley Reader</h2><nav><ul><li><a href=1>Farm</a></li><li><a href=2>Weather</a></li></ul></nav></header><main><article data-content><h2><a href=x>Snow came early to the upper farms</a></h2>
    <p>Nobody had brought the sheep down yet.</p><p><a href=y>A map of the closed roads</a></p><p>The road over the pass stays closed until the plough has been repaired.</p></article>
    <section class="related"><h3>More</h3><ul><li><a href=r>How the pass was built by hand a century ago</a></li><li><a href=q>Ten days without power</a></li></ul></section></main>
    <footer><p>The Valley Reader is printed on paper from the valley.</p></footer></body>""",
    """<body><div class="page"><h1>Untitled</h1><ul class="menu"><li><a href=1>One</a><li><a href=2>Two</a></ul><div data-content><p>Plain pages without any names have been written since the first days of the web.</p>
    <p>They hold a heading, <a href=z>a link</a> or two, and text.</p><table><tr><th>Year</th><th>Pages</th></tr><tr><td>1993</td><td>600</td></tr></table><details><summary>How it was counted</summary><p>By hand, with the help of two lists.</p></details></div>
    <hr><p class="copyright">&copy; 1999 by the owner of this page. Last changed in May.</p></div></body>""",
    """<body><nav class="breadcrumb"><a href=/>Home</a> &gt; <a href=/r>Recipes</a></nav><article class="recipe" data-content><h1>Leek soup</h1><p>A soup for the days on which nothing else is in the house.</p><h2>You need</h2>
    <ul><li>Three leeks</li><li>Two potatoes</li><li>Salt</li></ul><h2>How to</h2><ol><li>Cut the leeks and wash them well.</li><li>Cook everything for half an hour.</li></ol><p><a href=b>Bread goes well with it</a></p></article>
    <div class="comments"><h3>3 comments</h3><article class="comment"><p>My mother made it just like that, with a little cream at the end.</p></article><article class="comment"><p><a href=u>Soup fan</a> says thanks.</p></article></div>
    <form class="subscribe"><p>Get a recipe a week by mail.</p><label>Mail</label><button>Send</button></form></body>""",
    """<body><div class="cookie-banner" role="alert"><p>This site uses cookies to remember your settings.</p><button>Accept</button></div><noscript><p>Please switch on scripts in your browser to see this page as it was meant.</p></noscript>
    <main data-content><h1>On knots</h1><p>A knot is judged by how it holds and by how it opens.</p><p>The sheet bend joins two ropes of unequal size; see <a href=f>the figure</a>.</p><figure><figcaption>A sheet bend, seen from the front.</figcaption></figure></main>
    <div class="social share"><a href=1>Share</a><a href=2>Like</a></div><footer><p>Written by sailors.</p><ul><li><a href=i>Imprint</a></li></ul></footer></body>""",
    """<body><nav><ul><li><a href=/1>Politik</a></li><li><a href=/2>Kultur</a></li></ul></nav><article data-content><h1>Das Museum zieht um</h1><p>Im Herbst zieht das Museum in die alte Halle am Fluss, wie die Stadt am Montag sagte.</p>
    <p><a href=k>Die Karte der neuen Wege zum Haus</a></p><h3><a href=h>Was mit dem alten Haus geschieht</a></h3><p>Es wird verkauft.</p></article><aside class="widget"><h4>Beliebt</h4><p><a href=b>Zehn Orte, die man im Winter sehen muss</a></p></aside>
    <div class="ad">Jetzt Karten kaufen und sparen.</div><footer>Alle Rechte vorbehalten.</footer></body>""",
    """<body><header><a href=/>Le Journal</a></header><div class="content" data-content><h1>La place du marché</h1><p>La place est fermée jusqu'au printemps, et les marchands se sont installés le long du quai.</p><ul><li><a href=p>Le plan des nouveaux emplacements</a></li><li>Les horaires ne changent pas.</li></ul>
    <p><a href=m>La mairie répond aux questions des habitants.</a></p></div><div class="sidebar"><ul><li><a href=1>Les plus lus</a></li><li><a href=2>La météo de la semaine</a></li></ul></div><div class="footer"><p>Mentions légales, le journal du marché.</p></div></body>""",
    """<body><div class="toolbar"><a href=1>Imprimir</a> <a href=2>Enviar</a></div><article data-content><h1>El río baja</h1><p>El río baja desde hace tres semanas y los barcos ya no llegan hasta el puente viejo.</p><p><a href=v>Vea las medidas de los últimos diez años.</a></p></article>
    <div class="related-posts"><p><a href=x>Por qué el río subió tanto en la primavera pasada</a></p></div><footer><p>Derechos reservados. Aviso legal.</p></footer></body>""",
    """<body><div class="thread"><article class="post" data-content><h1>Which saw for green wood?</h1><p>I want to cut willow while it is wet, and my fine saw gets stuck in it after a few strokes.</p><p><a href=p>Here is a picture of the saw.</a></p></article>
    <div class="replies"><div class="reply"><p>Take a coarse blade with a wide set, and keep it clean while you work.</p></div><div class="reply"><p>An old bow saw does it.</p></div></div></div><nav class="pagination"><a href=1>1</a> <a href=2>2</a></nav></body>""",
    """<body><table class="layout"><tr><td class="menu"><a href=1>Home</a><br><a href=2>Links</a></td><td data-content><h1>My telescope</h1><p>It was built from a stove pipe and a lens that a friend had left over.</p><p>First light was on a cold night in March.</p><p><a href=g>Drawings of the mount</a></p></td></tr></table>
    <p class="disclaimer">No warranty for anything on this page, use it at your own risk.</p></body>""",
    """<body><nav id="toc" class="toc"><ul><li><a href=#1>Start</a></li><li><a href=#2>Middle game</a></li></ul></nav><section data-content><h2>Start</h2><p>Bring the small pieces out first.</p><pre>1. e4 e5</pre><h2>Middle game</h2><p>Plans matter more than single moves, and a plan needs a weak square to aim at.</p>
    <blockquote><p>He who has the centre has the game.</p></blockquote><dl><dt>Fork</dt><dd>Two pieces attacked at once.</dd></dl></section><section class="newsletter"><h2>Letter</h2><p>One game a week, with notes, in your mail box.</p></section></body>""",
    """<body><main><article data-content><header><h1>Report on wells</h1><p>By the office of water</p></header><p>Forty wells were measured in the dry month, and thirty of them stood lower than a year ago.</p><p><a href=t>Table of all wells</a></p><p><a href=m>Method of the measurements and its limits</a></p>
    <footer><p>Next report in autumn.</p></footer></article></main><footer class="site-footer"><p>Office of water, Well Street 1. <a href=c>Contact</a></p></footer></body>""",
    """<body><nav><a href=/>Home</a></nav><article><h1 data-content>A boat for two</h1><p data-content>The boat is light enough to be carried by two, and it is stiff in the wind.</p><p data-content>It took a winter to build.</p>
    <section class="comments"><h2>Comments</h2><p>I would like to build one, too, thank you for the plans.</p><div class="comment"><p>Ours leaked for a year.</p></div></section></article><footer><p>Boat yard news.</p></footer></body>""",
    """<body><article><h1 data-content>Short walks</h1><div class="ad"><p>Boots for every walk, now at a lower price.</p></div><p data-content>The first walk leads along the brook to the old lime kiln.</p><aside><p>Also read: the long walks of last year.</p></aside>
    <p data-content>The second one needs a dry day.</p><form><p>Leave your mail address and we send a walk a month.</p><input></form><div class="share"><a href=1>Share</a></div></article><footer>&copy; Walks</footer></body>""",
    """<body><main><div class="post"><h1 data-content>Painting a fence</h1><p data-content>Wash it first, let it dry for two days, and do not paint in the sun.</p><p data-content><a href=c>The chart of colours</a></p><p data-content>Two thin coats last longer than a thick one.</p>
    <div id="comments"><article class="comment"><p>Ours has lasted for eight years now, and it still looks well.</p></article><div class="reply"><p>Which paint was that?</p></div></div><div class="related"><ul><li><a href=r>Mending a gate that hangs</a></li></ul></div></div></main></body>""",
    """<body><div class="content"><h2 data-content>The clock in the tower</h2><p data-content>It is wound by hand on Mondays and strikes the hours only.</p><div class="notice"><p>The tower is closed to visitors until further notice.</p></div><p data-content>Its wheels are of oak.</p>
    <div class="newsletter"><p>News of the tower by mail, four times a year.</p></div><nav><ul><li><a href=1>Earlier</a></li><li><a href=2>Later</a></li></ul></nav></div><footer><p>Friends of the tower, by the church.</p></footer></body>""",
    """<body><article class="story"><header><h1 data-content>Der lange Regen</h1></header><p data-content>Es regnet seit drei Wochen, und die Wiesen am Fluss stehen unter Wasser.</p><p data-content>Nun wird Sand gebraucht.</p><section id="kommentare" class="comments"><p>Bei uns im Dorf steht das Wasser schon im Keller.</p></section>
    <section class="recommended"><p><a href=x>Wie man einen Keller trocken hält</a></p></section></article><div class="footer">Worte des Verlags am Ende.</div></body>""",
]
