"""The labelled table of html_blocks: pages of common shapes, written by hand. Main text has the attribute data-main; {n} stands for n words."""

from __future__ import annotations

import re

_WORDS = "the report of a town in which people have a word for each kind of rain and for the light that comes after it".split()

PAGES = (
    # News article with banner, share bar, advertisement within the text, related links and footer.
    """<div>Accept cookies</div><nav><ul><li><a href=/>Home</a><li><a href=/w>World</a><li><a href=/s>Sport</a></ul></nav><h1 data-main>{9}</h1><div>By Jane Roe</div><p data-main>{34}.</p><p data-main>{58}.</p>
    <div>Advertisement</div><p data-main>{71} <a href=/x>{3}</a> {4}.</p><h2 data-main>{4}</h2><p data-main>{40}.</p><div><a href=/t>Share</a> <a href=/m>Mail</a></div><h3>More on this</h3><ul><li><a href=/1>{8}</a><li><a href=/2>{7}</a></ul><footer>Copyright 2024</footer><div>All rights reserved</div>""",
    # Blog post without navigation, opened by a newsletter line, closed by a comment form.
    """<div>Subscribe now</div><article><h1 data-main>{5}</h1><p data-main>{66}.</p><p data-main>{12}.</p><p data-main>{3}.</p><p data-main>{90}.</p></article><div>Leave a comment</div><div>Name</div><div>Your email address will not be published.</div><div>Post comment</div>""",
    # Encyclopedia entry: many links in text, lists, a table of contents.
    """<div>From a free encyclopedia</div><h1 data-main>{2}</h1><p data-main>{30} <a href=a>{2}</a> {25} <a href=b>{1}</a> {14}.</p><div>Contents</div><ul><li><a href=#1>1 History</a><li><a href=#2>2 Use</a></ul><h2 data-main>{1}</h2><p data-main>{80} <a href=c>{4}</a> {9}.</p>
    <ul><li data-main>{6}.<li data-main>{9}.<li data-main>{14}.</ul><h2>See also</h2><ul><li><a href=q>{2}</a><li><a href=r>{3}</a></ul><div>This page was last edited on 3 May 2021.</div><ul><li><a href=p>Privacy policy</a><li><a href=d>Disclaimers</a></ul>""",
    # Shop page: short description between controls.
    """<div>Free delivery from 30 euros</div><ul><li><a href=1>Shoes</a><li><a href=2>Bags</a><li><a href=3>Sale</a></ul><h1 data-main>{4}</h1><div>49.90</div><div>In stock</div><div>Add to basket</div><p data-main>{45}.</p><p data-main>{18}.</p>
    <h3>You may also like</h3><div><a href=x>{5}</a></div><div><a href=y>{6}</a></div><div>Sign up for offers</div><div>Terms apply. Prices include tax.</div>""",
    # Forum thread.
    """<div><a href=/>Board index</a></div><div>12 posts</div><h2 data-main>{6}</h2><div>Posted by user 7 on Monday</div><p data-main>{26}?</p><div>Reply</div><div>Posted by user 9 on Tuesday</div><p data-main>{55}.</p><p data-main>{7}.</p><div>Reply</div><div>Powered by a board engine</div>""",
    # Documentation: headings, steps in lists, sidebar.
    """<aside><ul><li><a href=1>Start</a><li><a href=2>Install</a><li><a href=3>Use</a></ul></aside><h1 data-main>{2}</h1><p data-main>{22}.</p><ol><li data-main>{11}.<li data-main>{8}.<li data-main>{15}.</ol><h2 data-main>{3}</h2><p data-main>{37}.</p><div><a href=n>Next page</a></div><div>Was this helpful? Yes No</div>""",
    # Text alone.
    "<p data-main>{64}.</p>", "<p data-main>{20}.</p><p data-main>{110}.</p>", "<div data-main>{200}.</div>", "<h1 data-main>{4}</h1><p data-main>{50}.</p>", "<div data-main>{48}.</div><div data-main>{62}.</div><div data-main>{35}.</div>",
    # No main text.
    "<div>Page not found</div><div><a href=/>Back</a></div>", "<ul><li><a href=1>{3}.</a><li><a href=2>{4}</a><li><a href=3>{2}.</a></ul>", "<p><a href=1>{4}.</a></p><p><a href=2>{5}?</a></p>", "<div>Loading</div>", "<div>Sign in</div><div>Password</div><div>Forgot password?</div><div>Continue</div>",
    "<h1>Archive</h1><div><a href=1>{9}</a> 3 May</div><div><a href=2>{12}</a> 2 May</div><div><a href=3>{7}</a> 1 May</div><div>Copyright 2020</div>",
    # Text in div blocks with line-like boilerplate between and after.
    """<div>Menu</div><div>Search</div><div data-main>{52}.</div><div>Advertisement</div><div data-main>{77}.</div><div>Share this</div><div data-main>{41}.</div><div>Tags</div><div><a href=t>{1}</a> <a href=u>{1}</a></div><div>About us. Contact. Imprint.</div>""",
    # A short advertising sentence before the heading, and a footer with a sentence.
    """<nav><a href=1>{1}</a> <a href=2>{1}</a> <a href=3>{1}</a></nav><div>{4}. {5}.</div><article><h1 data-main>{10}</h1><p data-main>{31}.</p><p data-main>{5}.</p></article><footer>2023 example.org {5}.</footer>""",
    """<nav><ul><li><a href=1>{1}.</a><li><a href=2>{1}</a><li><a href=3>{1}.</a></ul></nav><div>{7}.</div><article><h1 data-main>{5}</h1><p data-main>{4}.</p></article><footer>2023 www.example.net {3}. {4}.</footer>""",
    """<nav><ul><li><a href=1>{1}</a><li><a href=2>{1}</a></ul></nav><div>{9}.</div><article><h1 data-main>{12}</h1><p data-main>{2}.</p><p data-main>{120}.</p><p data-main>{1}.</p></article><footer>2023 example.com {8}.</footer>""",
    # Paragraphs that don't end as sentences do: verse, text before a list, text that ends in a link; and notices that do.
    """<h1 data-main>{3}</h1><p data-main>{24}</p><p data-main>{31}</p><p data-main>{22}</p><p>Share this</p>""", "<p data-main>{70}</p>", "<p data-main>{41}</p><p data-main>{27} <a href=x>{3}</a></p>", "<article data-main>{90}</article>",
    """<div>We use cookies to improve this site.</div><div>Accept</div><h2 data-main>{4}</h2><p data-main>{26}</p><ul><li data-main>{7}<li data-main>{9}</ul><p data-main>{55}.</p><p>Please enable scripts.</p><p><a href=1>Home</a> <a href=2>About</a></p>""",
    # Short paragraphs after short headings and after each other.
    """<h1 data-main>{2}</h1><p data-main>{3}.</p><p data-main>{2}.</p><p data-main>{36}.</p><p data-main>{1}.</p><p data-main>{4}.</p><div>{3}.</div>""",
    """<nav><a href=1>{1}</a> <a href=2>{1}.</a></nav><div>{5}.</div><h1 data-main>{1}</h1><p data-main>{4}.</p><p data-main>{19}.</p><p data-main>{3}.</p><footer>2022 example.com {2}.</footer>""",
    # Recipe: list items without full stops are text.
    """<div>Skip to content</div><h1 data-main>{3}</h1><div>Rating 4.5</div><p data-main>{28}.</p><h2 data-main>{1}</h2><ul><li data-main>{4}<li data-main>{5}<li data-main>{3}<li data-main>{4}</ul><h2 data-main>{1}</h2><p data-main>{63}.</p><div>Print</div><div>Save</div><p>Follow us for more</p>""",
    # Press release with a quotation and contact lines.
    """<h1 data-main>{11}</h1><p>12 June 2022</p><p data-main>{70}.</p><blockquote data-main>{33}.</blockquote><p data-main>{59}.</p><p>Press contact</p><p>Telephone 555 0100</p><div>Cookie settings</div>""",
    # Paragraph tags around boilerplate on both sides.
    """<p>Accept all</p><p>Log in</p><h1 data-main>{6}</h1><p data-main>{47}.</p><p data-main>{29}.</p><p>Subscribe</p><p>Read more</p><p>All rights reserved</p>""",
    """<p>Subscribe now</p><p data-main>{60}.</p><p>Copyright 2021</p><p>All rights reserved</p>""", """<div>Accept cookies</div><div>Subscribe now</div><p data-main>{60}.</p><div>Copyright 2021</div><div>All rights reserved</div>""",
    # A search result list: snippets are not an article.
    """<div>About 900 results</div><h3><a href=1>{6}</a></h3><div>{14} ...</div><h3><a href=2>{7}</a></h3><div>{16} ...</div><h3><a href=3>{5}</a></h3><div>{15} ...</div><div><a href=2>Next</a></div>""",
    # Legal notices at the foot.
    """<ul><li><a href=1>{2}</a><li><a href=2>{2}</a></ul><h1 data-main>{7}</h1><p data-main>{38}.</p><p data-main>{84}.</p><div>{22} <a href=1>terms of use</a> and <a href=2>privacy policy</a>.</div><div>Copyright 2019 Example Ltd. All rights reserved.</div>""",
)


def labelled_pages() -> list[str]:
    """The pages with words in place of their numbers."""
    return [re.sub(r"\{(\d+)\}", lambda m: " ".join(_WORDS[i % len(_WORDS)] for i in range(int(m[1]))), page) for page in PAGES]
