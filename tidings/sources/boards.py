"""Readers of list and detail pages, one for each kind of board.

A board knows its page addresses and turns page bodies into list items and details; fetching is someone else's work. All
take the source's catalogue entry as a plain dict. A row or entry that can't be read is left out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from html import unescape

from tidings.functions.dom import Element, node_attr, node_text, parse
from tidings.functions.urls import origin_url, query_value, quoted_query, resolve_url, with_missing_params, without_param

# File endings that make a link an attachment.
FILE_ENDINGS = (
    "pdf hwp hwpx xlsx xls docx doc pptx ppt zip rar 7z txt csv tsv rtf xml json jpg jpeg png gif webp bmp tiff svg mp3 mp4 mov avi mkv wav"
).split()
FILE_LINK = re.compile(r"\.(?:" + "|".join(FILE_ENDINGS) + r")$", re.IGNORECASE)
UPLOADS = "/wp-content/uploads/"
CONTENT_FALLBACKS = ("div.board-view-content-wrap", "div.fr-view")


def number(text: str | None) -> int:
    m = re.search(r"\d+", text or "")
    return int(m[0]) if m else 0


def item(no: int, title: str, href: str, *, category: str = "", author: str = "", date: str = "", views: int = 0) -> dict:
    return {"articleNo": no, "title": title, "category": category, "author": author, "date": date, "views": views, "detailPath": href}


def detail(content: str, text: str, attachments: list[dict], title: str | None = None) -> dict:
    return {"content": content, "contentText": text, "attachments": attachments, "title": title}


def normalize_date(text: str, as_of: str) -> str:
    """`MM-DD` and `YY-MM-DD` with a full year; a month after that of `as_of` (YYYY-MM-DD) belongs to the year before."""
    if re.fullmatch(r"\d{2}-\d{2}", text):
        year, month = int(as_of[:4]), int(as_of[5:7])
        return f"{year - (int(text[:2]) > month)}-{text}"
    return f"20{text}" if re.fullmatch(r"\d{2}-\d{2}-\d{2}", text) else text


def labelled(texts: list[str]) -> dict[str, str]:
    """`KEY : value` lines as a map with upper-case keys; of equal keys the last counts."""
    found = (re.match(r"(.+?)\s*:\s*(.+)$", t) for t in texts)
    return {m[1].strip().upper(): m[2].strip() for m in found if m}


LARGEST = 2**63 - 1


def readable(read: Callable, rows: list) -> list[dict]:
    """What `read` makes of each row; rows that it can't read, and those whose number is none or too large, are left out."""
    out = []
    for row in rows:
        try:
            found = read(row)
        except (KeyError, TypeError, ValueError, AttributeError, IndexError):
            continue
        if found and isinstance(found["articleNo"], int) and 0 <= found["articleNo"] <= LARGEST:
            out.append(found | {"views": found["views"] if isinstance(found["views"], int) and 0 <= found["views"] <= LARGEST else 0})
    return out


def _first(root: Element, selector: str | None) -> Element | None:
    return root.select_one(selector) if selector else None


class Board:
    """What most boards share: rows with a link whose address holds the number of the article."""

    id_pattern = r"articleNo=(\d+)"
    row = "listRow"
    encoding = "utf-8"
    errors = "strict"

    def list_url(self, c: dict, page: int) -> str:
        return f"{c['baseUrl']}?{c['boardParam']}={c['boardName']}&page={page + 1}"

    def view_query(self, c: dict, no: int) -> str:
        return f"{c['boardParam']}={c['boardName']}&wr_id={no}"

    def detail_url(self, c: dict, path: str, no: int) -> str:
        if path.startswith("http"):
            return path
        return c["baseUrl"] + path if path.startswith("?") else f"{c['baseUrl']}?{self.view_query(c, no)}"

    def items(self, body: str, c: dict, page: int, as_of: str) -> list[dict]:
        return readable(lambda row: self.read(row, c, page, as_of), parse(body).select(c["selectors"][self.row]))

    def read(self, row: Element, c: dict, page: int, as_of: str) -> dict | None:
        raise NotImplementedError

    def number_in(self, href: str) -> int | None:
        m = re.search(self.id_pattern, href)
        return int(m[1]) if m else None

    def detail(self, body: str, c: dict, path: str, no: int) -> dict:
        root = parse(body)
        content, text = self.content(root, c)
        return detail(content, text, self.attachments(root, c, self.detail_url(c, path, no)))

    def title(self, root: Element, c: dict) -> str | None:
        return None

    def content(self, root: Element, c: dict) -> tuple[str, str]:
        e = _first(root, c["selectors"].get("detailContent"))
        return (e.inner_html().strip(), node_text(e)) if e else ("", "")

    def attachments(self, root: Element, c: dict, page_url: str) -> list[dict]:
        out = []
        for a in root.select(c["selectors"].get("detailAttachment") or ""):
            name, href = node_text(a), a.attr("href")
            if name and href:
                href = "https:" + href if href.startswith("//") else href
                out.append({"name": name, "url": origin_url(c["baseUrl"], href) if not href.startswith("?") else origin_url(c["baseUrl"], "/" + href), "referer": page_url})
        return out


class Standard(Board):
    """Definition-list boards, with positional or labelled facts."""

    row = "listItem"
    id_pattern = r"articleNo=(\d+)"

    def _extra(self, c: dict) -> str:
        return "".join(f"{k}={v}&" for k, v in (c.get("extraParams") or {}).items())

    def list_url(self, c, page):
        p = c["pagination"]
        return f"{c['baseUrl']}?{self._extra(c)}mode=list&articleLimit={p['limit']}&{p['param']}={page * p['limit']}"

    def detail_url(self, c, path, no):
        if path.startswith("?") and c.get("extraParams"):
            return f"{c['baseUrl']}?{with_missing_params(path[1:], c['extraParams'])}"
        return super().detail_url(c, path, no)

    def view_query(self, c, no):
        return f"{self._extra(c)}mode=view&articleNo={no}&article.offset=0&articleLimit=10"

    def number_in(self, href):
        m = re.search(r"articleNo=(\d+)", href) or re.search(r"itemId=(\d+)", href)
        return int(m[1]) if m else None

    def facts(self, row, c) -> tuple[str, str, int]:
        texts = [node_text(x) for x in row.select(c["selectors"]["infoList"])]
        if c.get("infoParser") == "labeled":
            by = labelled(texts)
            return by.get("WRITER", ""), by.get("POSTED DATE", ""), number(by.get("HIT"))
        texts += [""] * (4 - len(texts))
        return texts[1], texts[2], number(texts[3])

    def read(self, row, c, page, as_of):
        s = c["selectors"]
        link = _first(row, s["titleLink"])
        href = node_attr(link, "href") or ""
        no = self.number_in(href)
        if no is None:
            return None
        author, date, views = self.facts(row, c)
        return item(no, node_text(link), href, category=node_text(_first(row, s.get("category"))).strip("[]"), author=author, date=date, views=views)

    def content(self, root, c):
        for selector in (c["selectors"].get("detailContent"), *CONTENT_FALLBACKS):
            if e := _first(root, selector):
                return e.inner_html().strip(), node_text(e)
        return "", ""

    def attachments(self, root, c, page_url):
        out = []
        for a in root.select(c["selectors"].get("attachmentList") or ""):
            href = a.attrs.get("href")
            if c.get("attachmentParser") == "onclick":
                m = re.search(r"location\.href='([^']+)'", a.attr("onclick"))
                href = m[1].replace("&amp;", "&") if m else None
            if node_text(a) and href and href != "#":
                out.append({"name": node_text(a), "url": origin_url(c["baseUrl"], href)})
        return out


class AspBoard(Standard):
    """Standard facts on pages in the old Korean encoding; paths count from the host."""

    encoding, errors = "cp949", "replace"

    def list_url(self, c, page):
        return f"{c['baseUrl']}?{self._extra(c)}{c['pagination']['param']}={page + 1}"

    def number_in(self, href):
        m = re.search(r"number=(\d+)", href)
        return int(m[1]) if m else None

    def read(self, row, c, page, as_of):
        found = super().read(row, c, page, as_of)
        return found and found | {"title": found["title"].lstrip("·").strip(), "category": ""}

    def detail_url(self, c, path, no):
        return path if path.startswith("http") else origin_url(c["baseUrl"], "/" + path.lstrip("/"))

    def content(self, root, c):
        e = _first(root, c["selectors"].get("detailContent"))
        if not e:
            return "", ""
        for x in e.select("style, head, title, meta, link"):
            x.remove()
        return e.inner_html().strip(), node_text(e)

    def attachments(self, root, c, page_url):
        links = ((node_text(a), a.attr("href")) for a in root.select(c["selectors"].get("attachmentList") or ""))
        return [{"name": n, "url": h if h.startswith("http") else origin_url(c["baseUrl"], "/" + h.lstrip("/"))} for n, h in links if n and h and h != "#"]


class Gnuboard(Board):
    """Two skins: table rows, and list entries whose title may hold a category to be left out."""

    id_pattern = r"wr_id=(\d+)"

    def read(self, row, c, page, as_of):
        s, table = c["selectors"], c.get("skinType") == "table"
        link = _first(row, s["titleLink"])
        href = node_attr(link, "href") or ""
        title = node_text(link)
        if table:
            if len(row.find_all("td")) < 2:
                return None
        else:
            href = "https:" + href if href.startswith("//") else href
            heading = _first(row, s.get("titleText"))
            if heading:
                category = node_text(heading.select_one("span.category"))
                title = node_text(heading)
                title = (title.replace(category, "") if category else title).strip()
        no = self.number_in(href)
        if not title or no is None:
            return None
        views = number(node_text(_first(row, s.get("views"))))
        return item(no, title, href, author=node_text(_first(row, s["author"])), date=normalize_date(node_text(_first(row, s["date"])), as_of), views=views)


class GnuboardCustom(Board):
    """Facts in one line parted by bars; pinned rows count on the first page only."""

    id_pattern = r"num=(\d+)"

    def view_query(self, c, no):
        return f"{c['boardParam']}={c['boardName']}&mode={c['detailMode']}&num={no}"

    def read(self, row, c, page, as_of):
        s = c["selectors"]
        if len(row.find_all("td")) < 2 or (page > 0 and row.select_one('img[src*="btn_notice"]')):
            return None
        link = _first(row, s["titleLink"])
        href, meta = node_attr(link, "href") or "", node_text(_first(row, s["meta"]))
        no = self.number_in(href)
        if no is None or not node_text(link):
            return None
        views = re.search(r"조회수\s*:\s*(\d+)", meta)
        return item(no, node_text(link), href, author=meta.split("|")[0].strip(), date=node_text(_first(row, s["date"])), views=int(views[1]) if views else 0)

    def content(self, root, c):
        e = _first(root, c["selectors"].get("detailContent"))
        html = without_word_processor_data(e.inner_html().strip()) if e else ""
        return html, node_text(parse(html))


def without_word_processor_data(html: str) -> str:
    """Without the documents that a word processor hides in comments and attributes."""
    return re.sub(r'\s*data-hwpjson="[^"]*"', "", re.sub(r"<!--\[data-hwpjson\].*?\[data-hwpjson\]-->", "", html, flags=re.DOTALL))


class CustomPhp(Board):
    id_pattern = r"idx=(\d+)"

    def list_url(self, c, page):
        return f"{c['baseUrl']}?{quoted_query(c['boardParams'])}&pg={page + 1}&page=list"

    def view_query(self, c, no):
        return f"page=view&idx={no}&{quoted_query(c['boardParams'])}"

    def read(self, row, c, page, as_of):
        s = c["selectors"]
        link = _first(row, s["titleLink"])
        href = node_attr(link, "href") or ""
        no = self.number_in(href)
        if len(row.find_all("td")) < 2 or not node_text(link) or no is None:
            return None
        facts = {n: node_text(_first(row, s.get(n))) for n in ("category", "views", "date")}
        return item(no, node_text(link), href, category=facts["category"], date=facts["date"], views=number(facts["views"]))

    def attachments(self, root, c, page_url):
        out: dict[str, dict] = {}
        folder = c["baseUrl"].rsplit("/", 1)[0]
        for a in root.select(c["selectors"].get("detailAttachment") or "div.attachment a[href]"):
            href = a.attr("href")
            if not href or href == "#":
                continue
            url = href if href.startswith("http") else origin_url(c["baseUrl"], href) if href.startswith("/") else f"{folder}/{href.removeprefix('./')}"
            name = query_value(url, "name") or node_text(a) or url.rsplit("/", 1)[-1]
            if name:
                out.setdefault(url, {"name": name, "url": url})
        return list(out.values())

    def title(self, root, c):
        return node_text(_first(root, c["selectors"].get("detailTitle"))) or None

    def detail(self, body, c, path, no):
        return super().detail(body, c, path, no) | {"title": self.title(parse(body), c)}


class JspDorm(Board):
    """Six positional columns; pinned rows, marked by their background, count on the first page only."""

    id_pattern = r"article_no=(\d+)"

    def list_url(self, c, page):
        p = c["pagination"]
        return f"{c['baseUrl']}?mode=list&board_no={c['boardNo']}&{p['param']}={page * p['limit']}"

    def view_query(self, c, no):
        return f"mode=view&article_no={no}&board_no={c['boardNo']}"

    def read(self, row, c, page, as_of):
        cells = row.find_all("td")
        pinned = "background:#f4f4f4" in row.attr("style").replace(" ", "")
        if len(cells) < 6 or (pinned and page > 0):
            return None
        link = cells[2].select_one("a")
        href, views = node_attr(link, "href") or "", node_text(cells[5])
        no = self.number_in(href)
        if no is None:
            return None
        return item(no, node_text(link), href, category=node_text(cells[1]), date=node_text(cells[4]), views=int(views) if views.isdigit() else 0)

    def attachments(self, root, c, page_url):
        links = ((node_text(a), a.attr("href")) for a in root.select(c["selectors"].get("attachmentLink") or ""))  # images have no text here
        return [{"name": n, "url": h if h.startswith("http") else origin_url(c["baseUrl"], "/" + h.lstrip("/"))} for n, h in links if n and h]


class WordPress(Board):
    """JSON posts; the list already holds the content of each."""

    def list_url(self, c, page):
        url = f"{c['baseUrl']}/?rest_route=/wp/v2/posts&per_page={c['pagination']['limit']}&page={page + 1}&_fields=id,title,date,link,content,categories"
        return url + (f"&categories={c['categoryId']}" if c.get("categoryId") else "")

    def detail_url(self, c, path, no):
        return f"{c['baseUrl']}/?rest_route=/wp/v2/posts/{no}&_fields=content"

    def items(self, body, c, page, as_of):
        """List items; those whose content came along carry it as `detail`. A body that isn't a list has none."""
        try:
            posts = json.loads(body)
        except ValueError:
            return []

        def read(p: dict) -> dict:
            html = (p.get("content") or {}).get("rendered", "")
            found = item(p["id"], unescape((p.get("title") or {}).get("rendered", "")), p.get("link") or "", date=(p.get("date") or "").split("T")[0])
            return found | {"detail": self._detail(html, c) if html else None}

        return readable(read, posts if isinstance(posts, list) else [])

    def detail(self, body, c, path, no):
        post = json.loads(body)
        return self._detail((post.get("content") or {}).get("rendered", ""), c) if isinstance(post, dict) else None

    def _detail(self, html: str, c: dict) -> dict:
        return detail(html, node_text(parse(html)), linked_files(html, c["baseUrl"]))


def linked_files(html: str, base: str) -> list[dict]:
    """Links to files and uploads, repeats and all, then blocks of the download manager that lead anywhere else."""
    root = parse(html)
    links = [(absolute(a.attr("href"), base), a) for a in root.select("a[href]") if FILE_LINK.search(a.attr("href")) or UPLOADS in a.attr("href").lower()]
    buttons = ((b.select_one("a[data-downloadurl]"), b) for b in root.select("div.w3eden"))
    managed = {}
    for button, block in buttons:
        if button is not None and button.attr("data-downloadurl"):
            managed.setdefault(without_param(absolute(button.attr("data-downloadurl"), base), "refresh"), (button, block))
    plain = [{"name": node_text(a) or a.attr("href").rpartition("/")[2] or "unknown", "url": url} for url, a in links]
    held = {url for url, _ in links}
    heading = "h3.package-title a, a.package-title"
    return plain + [{"name": node_text(block.select_one(heading)) or node_text(button) or "download", "url": url} for url, (button, block) in managed.items() if url not in held]


def absolute(href: str, base: str) -> str:
    return href if href.startswith("http") else resolve_url(href, base)


class Pyxis(Board):
    """A library's JSON bulletins; attachments of the list are better than those of the detail."""

    def list_url(self, c, page):
        n = c["pagination"]["limit"]
        url = f"{c['baseUrl']}/bulletin-boards/{c.get('bulletinBoardId') or 1}/bulletins?max={n}&offset={page * n}"
        return url + (f"&bulletinCategoryId={c['bulletinCategoryId']}" if c.get("bulletinCategoryId") else "")

    def detail_url(self, c, path, no):
        return f"{c['baseUrl']}/bulletins/{no}"

    @staticmethod
    def _data(body: str) -> dict | None:
        try:
            envelope = json.loads(body)
        except ValueError:
            return None
        return envelope.get("data") if isinstance(envelope, dict) and envelope.get("success") else None

    def items(self, body, c, page, as_of):
        data = self._data(body)
        if not data or page * c["pagination"]["limit"] >= data.get("totalCount", 0):
            return []

        def read(b: dict) -> dict:
            found = item(
                b["id"], b.get("title", ""), f"{c.get('frontendBase') or c['baseUrl']}/{b['id']}", category=(b.get("bulletinCategory") or {}).get("name", ""),
                author=b.get("writer", ""), date=(b.get("dateCreated") or "")[:10], views=b.get("hitCnt", 0))
            return found | {"attachments": self.files(b.get("attachments") or [], c) or None}

        return readable(read, data.get("list") or [])

    def detail(self, body, c, path, no):
        data = self._data(body)
        if not data:
            return None
        html = data.get("content", "")
        return detail(html, node_text(parse(html)), self.files(data.get("attachments") or [], c))

    @staticmethod
    def files(raw: list[dict], c: dict) -> list[dict]:
        out = []
        for x in raw:
            url = f"{c.get('attachmentBase') or c['baseUrl']}/{x['physicalName']}" if x.get("physicalName") else (c.get("imageBase") or c["baseUrl"]) + x["originalImageUrl"] if x.get("originalImageUrl") else ""
            if url:
                out.append({"name": x.get("logicalName", "unknown"), "url": url})
        return out


#: Kinds of boards.
BOARDS: dict[str, Board] = {
    "standard": Standard(), "asp-board": AspBoard(), "gnuboard": Gnuboard(), "gnuboard-custom": GnuboardCustom(), "custom-php": CustomPhp(),
    "jsp-dorm": JspDorm(), "wordpress-api": WordPress(), "pyxis-api": Pyxis(),
}
# The selectors that each kind must have, and whether its lists show a category and an author.
REQUIRED_SELECTORS: dict[str, list[str]] = {
    "standard": ["listItem", "category", "titleLink", "infoList", "detailContent", "attachmentList"],
    "asp-board": ["listItem", "titleLink", "infoList", "detailContent", "attachmentList"],
    "gnuboard": ["listRow", "titleLink", "author", "date", "detailContent", "detailAttachment"],
    "gnuboard-custom": ["listRow", "titleLink", "date", "meta", "detailContent", "detailAttachment"],
    "custom-php": ["listRow", "titleLink", "category", "views", "date", "detailContent"],
    "jsp-dorm": ["listRow", "pinnedRow", "titleLink", "detailContent", "attachmentLink"],
    "wordpress-api": [],
    "pyxis-api": [],
}
FEATURES: dict[str, tuple[bool, bool]] = {
    "standard": (True, True), "pyxis-api": (True, False), "jsp-dorm": (True, False), "custom-php": (True, False), "gnuboard": (False, True),
    "gnuboard-custom": (False, True), "asp-board": (False, True), "wordpress-api": (False, False),
}


def rename(names: Mapping[str, str]) -> None:
    """Other names for kinds of boards, as a catalogue uses them: name -> kind."""
    for name, kind in names.items():
        register(name, BOARDS[kind], REQUIRED_SELECTORS[kind], FEATURES[kind])


def register(name: str, board: Board, required: list[str] = (), features: tuple[bool, bool] = (False, False)) -> None:
    """Add a kind of board, or another name for one."""
    BOARDS[name], REQUIRED_SELECTORS[name], FEATURES[name] = board, list(required), features
