"""Operator 6: parts of an article that are links, and reader comments, on written pages with their gold blocks."""

import pytest

from landfall.llm.html_extract import main_text

P1 = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt."
P2 = "Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris, nisi ut aliquip ex ea commodo."
P3 = "Duis aute irure dolor in reprehenderit, in voluptate velit esse cillum dolore eu fugiat nulla pariatur."
C = "I think that this is wrong, and I have said so before; others may differ, of course."
PARAS = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
GOLD = [P1, P2, P3]
NAV = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
REFS = "".join(f"<li><a href='https://example.org/{i}'>Reference number {i}</a></li>" for i in range(4))
REF_TEXT = [f"Reference number {i}" for i in range(4)]
COMMENTS = "".join(f"<p>{C}</p>" for _ in range(3))

PAGES = {
    "heading to its own place": (f"<article><h1>T</h1>{PARAS}<h2><a href=#s>Section heading</a></h2>{PARAS}</article>",
                                 ["T", *GOLD, "Section heading", *GOLD]),
    "heading with a pilcrow": (f"<article>{PARAS}<h2>Part <a href='#p'>¶</a></h2>{PARAS}</article>", [*GOLD, "Part ¶", *GOLD]),
    "heading that links away, text below": (f"<main>{PARAS}<h2><a href=/more>A linked heading</a></h2>{PARAS}</main>",
                                            [*GOLD, "A linked heading", *GOLD]),
    "no article element": (f"<div id=page>{NAV}<div class=text><h1>T</h1>{PARAS}<h3><a href=#x>Anchor</a></h3>{PARAS}</div></div>",
                           ["T", *GOLD, "Anchor", *GOLD]),
    "references under a heading": (f"<article>{PARAS}<h2>References</h2><ul>{REFS}</ul></article>", [*GOLD, "References", *REF_TEXT]),
    "numbered references": (f"<article>{PARAS}<h2>Sources</h2><ol>{REFS}</ol></article>", [*GOLD, "Sources", *REF_TEXT]),
    "references after a colon": (f"<main>{PARAS}<p>{P1[:-1]}, see also:</p><ul>{REFS}</ul></main>", [*GOLD, P1[:-1] + ", see also:", *REF_TEXT]),
    "references with paragraphs inside": (f"<article>{PARAS}<h2>References</h2><ul>" + REFS.replace("<li>", "<li><p>").replace("</li>", "</p></li>")
                                          + "</ul></article>", [*GOLD, "References", *REF_TEXT]),
    "text after references": (f"<article>{PARAS}<h2>References</h2><ul>{REFS}</ul>{PARAS}</article>", [*GOLD, "References", *REF_TEXT, *GOLD]),
    "list of links without a heading": (f"<article>{PARAS}<ul>{REFS}</ul></article>", GOLD),
    "related box with a heading": (f"<article>{PARAS}<div class='related-posts'><h3>Related</h3><ul>{REFS}</ul></div></article>", GOLD),
    "menu above": (f"<div>{NAV}</div><article><h2>Contents</h2>{PARAS}</article>", ["Contents", *GOLD]),
    "aside with links": (f"<article>{PARAS}<aside><h2>More</h2><ul>{REFS}</ul></aside></article>", GOLD),
    "reader comments in main": (f"<main>{PARAS}<section class='reader-comments'>{COMMENTS}</section></main>", GOLD),
    "user comments, no article": (f"<div><div class=body>{PARAS}</div><div class='user-comments'>{COMMENTS}</div></div>", GOLD),
    "many comments": (f"<article>{PARAS}<div id='comments'>{COMMENTS * 6}</div></article>", GOLD),
    "comment list": (f"<article>{PARAS}<ol class='comment-list'><li class='comment'>{COMMENTS}</li></ol></article>", GOLD),
    "comment thread": (f"<main>{PARAS}<div class='commentThread'><div class='comment-body'>{COMMENTS}</div></div></main>", GOLD),
    "comments wrapper": (f"<main><h1>T</h1>{PARAS}<div id='wp-comments-wrapper'>{COMMENTS * 2}</div></main>", ["T", *GOLD]),
    "disqus thread": (f"<article>{PARAS}<div id=disqus_thread>{COMMENTS}</div></article>", GOLD),
    "an article about comments": (f"<article><h1>On code comments</h1><div class='code-comments-guide'>{PARAS}</div></article>",
                                  ["On code comments", *GOLD]),
    "a forum page of comments only": (f"<main><h1>T</h1><div class='comments'>{COMMENTS}{PARAS}</div></main>", ["T", C, C, C, *GOLD]),
    "figure and caption": (f"<article>{PARAS}<figure><img src=x><figcaption>A caption, of a picture.</figcaption></figure></article>",
                           [*GOLD, "A caption, of a picture."]),
    "table": (f"<article>{PARAS}<table><tr><th>Year<th>Sum<tr><td>1999<td>12</table></article>", [*GOLD, "Year", "Sum", "1999", "12"]),
    "quote": (f"<article>{PARAS}<blockquote>{P1}</blockquote></article>", [*GOLD, P1]),
    "plain list": (f"<article>{PARAS}<ul><li>One thing<li>Another thing</ul></article>", [*GOLD, "One thing", "Another thing"]),
    "cookie notice": (f"<div class='cookie-notice'>We use cookies, as all do.</div><article>{PARAS}</article>", GOLD),
    "advert inside": (f"<article><p>{P1}</p><div class=advert>Buy now, please.</div><p>{P2}</p><p>{P3}</p></article>", GOLD),
    "share bar": (f"<article>{PARAS}<div class='share-buttons'><a href=x>Share</a><a href=y>Post</a></div></article>", GOLD),
    "form": (f"<article>{PARAS}<form><label>Your mail, please</label><input></form></article>", GOLD),
    "two headings of the page": (f"<header><h2>Site name</h2></header><main><h1>T</h1>{PARAS}</main><footer>End, of page.</footer>", ["T", *GOLD]),
    "teasers beside": (f"<main>{PARAS}</main><div class=sidebar><h3><a href=/x>Other story</a></h3><p>{P1}</p></div>", GOLD),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, gold = PAGES[name]
    assert main_text(page).split("\n\n") == gold


def test_precision_and_recall():
    """Blocks over all written pages; the README states both."""
    found = right = wanted = 0
    for page, gold in PAGES.values():
        got = main_text(page).split("\n\n")
        left = list(gold)
        for block in got:
            if block in left:
                left.remove(block)
                right += 1
        found, wanted = found + len(got), wanted + len(gold)
    assert len(PAGES) >= 30
    print(f"precision {right / found:.3f} recall {right / wanted:.3f} of {wanted} blocks")
    assert right / found >= 0.98 and right / wanted >= 0.98
