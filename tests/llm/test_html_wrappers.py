"""Articles inside wrappers whose names, or whose tag, speak of something else."""

import pytest

from parityloom.llm.html_text import main_text

P = " ".join(["Some plain words of the article stand in this paragraph."] * 6)
Q = P.replace("article", "remark")
INNER = f'<main class="content"><article class="post"><div class="entry-content"><p>{P}</p></div></article></main>'


@pytest.mark.parametrize("opened", ['<div class="content-sidebar-wrap">', '<div class="has-sidebar">', '<div id="page" class="site-header-fixed has-related">', '<form id="aspnetForm" action="/">', '<form class="x"><div class="has-sidebar"><div>', "<div class='search share nav'>"])
@pytest.mark.parametrize("inner", [INNER, f"<article><p>{P}</p></article>", f"<main><p>{P}</p></main>"])
def test_article_in_a_wrapper_of_another_name_is_kept(opened, inner):
    page = f'<html><body>{opened}{inner}<div class="sidebar"><p>{Q}</p></div></div></form></body></html>'
    assert main_text(page) == P


def test_several_articles_in_one_wrapper_are_kept():
    assert main_text(f'<div class="has-sidebar has-comments"><article><p>{P}</p></article><article><p>{P}</p></article></div>') == f"{P}\n{P}"


@pytest.mark.parametrize("away", ["<aside>{}</aside>", "<nav><div class='menu'>{}</div></nav>", "<div hidden class='menu'>{}</div>", "<div class='comments'>{}</div>", "<section class='related-posts'><form>{}</form></section>"])
def test_what_an_article_does_not_replace(away):
    assert main_text(f"<article><p>{P}</p></article>" + away.format(f"<article class='post'><p>{Q}</p></article>")) == P
