"""Named blocks of an article, lists of references, comments that outweigh a post."""

import pytest

from voxmill.llm import extraction

PROSE = "This paragraph of prose belongs to the text, whatever the block around it is called, and it is as long as the others are."
BEGIN = "<h1>A title of some words</h1>" + "".join(f"<p>{PROSE} Number {k}.</p>" for k in range(4))
TEXT = "A title of some words\n" + "\n".join(f"{PROSE} Number {k}." for k in range(4))


@pytest.mark.parametrize("mark", ["section id='cookies'", "section id='menu'", "section class='related'", "div class='notice'", "div class='social'"])
def test_prose_in_named_blocks_stays(mark):
    inner = f"{BEGIN}<{mark}><p>{PROSE} Last.</p></{mark.split()[0]}>"
    assert extraction.main_text(f"<body><nav><a href=x>Home</a></nav><article>{inner}</article></body>") == f"{TEXT}\n{PROSE} Last."
    assert extraction.main_text(f"<body><div class='top'><a href=x>Home</a></div><div>{inner}</div></body>") == f"{TEXT}\n{PROSE} Last."


def test_inline_nodes_are_never_cut():
    page = f"<article>{BEGIN}<p>Words <span class='search'>of a search</span> and <b id='menu'>more</b>.</p></article>"
    assert extraction.main_text(page) == f"{TEXT}\nWords of a search and more."


def test_linked_references_stay_in_an_article():
    links = "".join(f"<li><a href='/{k}'>A reference to another work {k}</a></li>" for k in range(5))
    want = TEXT + "".join(f"\nA reference to another work {k}" for k in range(5))
    assert extraction.main_text(f"<article>{BEGIN}<ol>{links}</ol></article>") == want
    assert extraction.main_text(f"<article>{BEGIN}<ol class='related'>{links}</ol></article>") == TEXT


@pytest.mark.parametrize("mark", ["div class='ad'", "div id='comments'", "section class='comment-list'", "div class='cookie-notice'", "div class='share-buttons'"])
def test_noise_in_an_article_goes(mark):
    page = f"<article>{BEGIN}<{mark}>Buy or say <a href=x>something</a></{mark.split()[0]}></article>"
    assert extraction.main_text(page) == TEXT
    long = f"<article>{BEGIN}<div id='comments'>{'<p>I do not agree with any of this, and here is why I do not.</p>' * 30}</div></article>"
    assert extraction.main_text(long) == TEXT


@pytest.mark.parametrize("n", [3, 40])
def test_comments_are_never_the_text(n):
    comments = "".join(f"<div class='comment'><p>I do not agree with any of this, and here is why I do not, at some length, number {k}.</p></div>" for k in range(n))
    post = f"<div class='post'><h1>A short post</h1><p>{PROSE}</p></div>"
    assert extraction.main_text(f"<body><div class='nav'><a href=x>Home</a></div>{post}<div id='comments'>{comments}</div></body>") == f"A short post\n{PROSE}"


def test_sidebars_and_notices_beside_a_text_go():
    page = f"<body><div id='content'>{BEGIN}</div><div class='sidebar'><p>{PROSE}</p></div><div class='cookie-notice'><p>We use cookies to make this page better.</p></div></body>"
    assert extraction.main_text(page) == TEXT


def test_a_named_wrapper_keeps_all():
    assert extraction.main_text(f"<body><div class='content'><div id='banner'>{BEGIN}</div></div></body>") == TEXT
