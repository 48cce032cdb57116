"""The channels that have rules of their own, as rows of a table.

A channel is nothing but values: where its listings are, which links on them are articles, how their cards are dated
and where the next page is. One reader (``listings``) knows what to do with them.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Cards:
    """Dated cards: where they stand, and what in them is a link, a date and the next page.

    ``heading`` (tags, text, whether the whole text) names a heading whose nearest ancestor ``within`` (a tag or part of a
    class) bounds the cards; ``root`` bounds them by a selector. A group is (selector of its elements, of links in them,
    of dates in the ``card`` around a link). ``dated`` says that the elements of a group are sections with a date of
    their own, in one of their direct children. The next page is a selector, or a link by its text.
    """

    groups: tuple[tuple[str, str, str], ...]
    root: str = ""
    heading: tuple[tuple[str, ...], str, bool] | None = None
    within: str = ""
    card: str = ""
    dated: bool = False
    next_: str = ""
    next_text: str = ""
    not_under: str = ""


@dataclass(frozen=True)
class Channel:
    """Rules of one channel. ``factor`` is how many times the limit of links is looked at before ``path`` decides."""

    selectors: tuple[str, ...] = ()
    path: str = ""
    factor: int = 1
    listings: tuple[str, ...] = ()
    own: bool = True
    own_first: bool = False
    site: str = ""
    not_paths: tuple[str, ...] = ()
    query: str = ""
    pages: int = 1
    next_: str = ""
    embedded: bool = True
    browser: bool = False
    workbook: str = ""
    feed_path: str = ""
    feed: str = ""
    cards: Cards | None = field(default=None)


#: Selectors of links on the listing of a channel without rules, those that come first count first.
GENERIC = (
    ".recommend-content-right a[href]", ".recommend-content a[href]", ".news-list a[href]", ".newslist a[href]", ".list a[href]", ".list_news a[href]", ".list-con a[href]",
    ".listCon a[href]", ".channel-list a[href]", ".sub-list a[href]", ".main-list a[href]", "article a[href]", ".post a[href]", ".entry-title a[href]", "h1 a[href]", "h2 a[href]",
    "h3 a[href]", "ul li a[href]", "main a[href]", "a[href]",
)
#: The channels by lower-case name.
CHANNELS: dict[str, Channel] = {
    "electrive": Channel(("article h3 a[href]", "article h2 a[href]", ".post-title a[href]", ".entry-title a[href]")),
    "光伏测试网": Channel(("a.xi2[href*='portal.php?mod=view']",), r"/portal\.php$", 2, query=r"(?:^|&)mod=view(?:&|$)(?:.*&)?aid=[^&]|(?:^|&)aid=[^&]+(?:&.*)?&mod=view(?:&|$)"),
    "索比光伏": Channel((".recommend-content-right a.title2[href]", ".Select-recommend-item a[href]"), r"(?i)^/20\d{4}/\d{1,2}/\d+\.html$", 2),
    "国际能源网": Channel(
        ("a[href*='/article/html/energy-']",), r"(?i)^/article/html/energy-\d+\.shtml$", 2,
        ("https://www.in-en.com/article/news/", "https://www.in-en.com/article/policy/intl/", "https://www.in-en.com/article/policy/china/"), browser=True, workbook="国际能源网_",
    ),
    "中国能源网": Channel((".list-item h2 a[href]", "a[href*='/news/news-']"), r"(?i)^/news/news-\d+-\d+\.html$", 2, ("https://www.china5e.com/news/energy-economy/",), browser=True, workbook="中国能源网_"),
    "我爱电车网": Channel((".entry-title a[href]", "a.topic-post-big[href]"), r"(?i)^/[a-z0-9-]+/[a-z0-9]+\.html$", 2, workbook="我爱电车网_"),
    "北极星储能网": Channel(("a[href*='news.bjx.com.cn/html/']",), r"(?i)^/html/20\d{6}/\d+\.shtml$", 2, ("https://chuneng.bjx.com.cn/yw/", "https://chuneng.bjx.com.cn/dj/", "https://chuneng.bjx.com.cn/sc/"), browser=True),
    "insideevs": Channel(("article h3 a[href]", "article h2 a[href]", "a[href*='/news/']"), r"(?i)^/news/\d+/[a-z0-9-]+/?$", 2),
    "interesting engineering": Channel(
        pages=20, feed="/feed",
        cards=Cards((("section", "h3 a[href]", ""),), heading=(("h1",), "news", True), within="article", dated=True, next_='a[aria-label="Go to next page"][href]', not_under="/news/page/"),
    ),
    "energytrend储能": Channel((".entry-title a[href]",), r"(?i)^/news/20\d{6}-\d+\.html$", 2, feed_path=r"(?i)^/news/20\d{6}-\d+\.html$"),
    "ne时代": Channel(("a.article-item[href]",), r"(?i)^/web/article/\d+/?$", 2),
    "电池网": Channel(
        (".list-item .item-top h2 a[href]",), r"(?i)^/news/[a-z0-9-]+/[a-z0-9]+\.html$", 2,
        ("https://www.itdcw.com/news/guonei/", "https://www.itdcw.com/news/guoji/", "https://www.itdcw.com/news/qiye/"), browser=True, workbook="电池网_",
    ),
    "x-mol": Channel((".news-list a[href]", "a[href*='/news/']"), r"(?i)^/news/\d+/?$", 2),
    "batteries international": Channel(("article h2 a[href]", ".td-module-title a[href]", ".entry-title a[href]", "h3 a[href]")),
    "batteries news": Channel(
        pages=20, cards=Cards((("article.gridlove-post", "h2.entry-title a[href]", ".meta-date .updated"),), heading=(("h1", "h2", "h3", "h4"), "latest", False), within=".gridlove-module", card="article.gridlove-post", next_text="load more")
    ),
    "data center knowledge": Channel(
        pages=20, feed="/rss.xml",
        cards=Cards(
            (
                (".ListContent-Content_featured", "a.ArticlePreview-Title[href]", ".ArticlePreview-Date"),
                (".ListContent-Content_latest", "a.ContentCard-Title[href]", ".ContentCard-Date"),
                (".ListContent-ContentItem", "a.ListPreview-Title[href]", ".ListPreview-Date"),
            ),
            root=".ListContent", card=".ContentPreview", next_='nav.ListContent-Pagination a[aria-label^="Go to Next page"][href]',
        ),
    ),
    "volta foundation": Channel(("article a[href]", "[class*='news'] a[href]", "main a[href]"), r"^/[^/?#]+/?$", 4, site="volta.foundation", not_paths=("/battery-news",)),
    "battery tech online": Channel(
        ("article a[href]", ".card a[href]", ".views-row a[href]", "h2 a[href]", "h3 a[href]"),
        r"^/(?:battery-news|ev-batteries|stationary-batteries|battery-applications|lithium-ion-batteries|design-manufacturing|automotive-mobility|batteries-energy-storage)/[^/?#]+/?$", 4,
        site="batterytechonline.com", not_paths=("/battery-news/battery-breaking-news-headlines",),
    ),
    "supply chain digital": Channel(("article a[href]", ".teaser a[href]", ".card a[href]", "h2 a[href]", "h3 a[href]")),
    "electrek": Channel(("article h1 a[href]", "article h2 a[href]", ".post-title a[href]", ".entry-title a[href]")),
    "pv magazine": Channel(("a.post-block__title[href]", "article h3 a[href]", "article h2 a[href]", ".article-list a[href]", ".entry-title a[href]")),
    "pv magazine c&i pv": Channel(
        (".pvmagazine-article-feed .pvmagazine-article-feed__inner .post-block a.post-block__title[href]",), r"(?i)^/20\d{2}/\d{1,2}/\d{1,2}/[^/?#]+/?$", 1, ("https://www.pv-magazine.com/latest-news/",), own=False,
        pages=12, next_=".pvmagazine-article-feed .pv-pagination-pagination a.next.page-numbers[href]", embedded=False,
    ),
    "renewables now": Channel(("a[href]",), r"(?i)^/news/(?!archive/?$)[a-z0-9-]+-\d+/?$", 1_000, embedded=False),
    "4c offshore": Channel(("a[href*='-nid'][href$='.html']",)),
    "科学网新闻": Channel(("a[href*='/htmlnews/']",), r"(?i)^/htmlnews/20\d{2}/\d{1,2}/\d+\.shtm$", 1_000, ("/todaynews.aspx", "/"), own_first=True, embedded=False, browser=True),
    "新华网科技": Channel(("#content-list .item .tit a[href]", "#content-list .item a[href]", ".list .item .tit a[href]", ".focus .tit a[href]")),
    "h2 view": Channel(GENERIC, r"(?i)^/(?:story|feature)/[^?#]+/\d+\.article/?$", 4, ("https://www.gasworld.com/h2-view/latest-news/",), browser=True),
    "国际太阳能光伏网": Channel(GENERIC, listings=("https://solar.in-en.com/news/SolarPV/",), browser=True),
    "新能源网": Channel(GENERIC, listings=("http://www.china-nengyuan.com/tech/",), browser=True),
    "perovskite-info": Channel(("article.node--type-story a[rel='bookmark'][href]", "article.node--type-story .field--name-title a[href]", "article.node--type-story a[href]")),
    "全球风电网": Channel(GENERIC, listings=("http://wp.china-nengyuan.com/tech/",), browser=True),
    "中国新能源网-新闻": Channel(GENERIC, listings=("http://www.china-nengyuan.com/news/",), browser=True),
}
OTHER = Channel(GENERIC)


def key(name: str | None) -> str:
    return (name or "").strip().lower()


def channel(name: str | None) -> Channel:
    """The rules of a channel by its name, in any case; those of a plain listing for any other."""
    return CHANNELS.get(key(name), OTHER)
