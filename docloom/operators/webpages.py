"""Archived pages as trees: field rules, list pages with postbacks, and what a page offers (forms, links, blocks, hints).

Pages are read by the standard parser into element trees, so broken markup never fails: an end tag closes the nearest
open element of its name, void elements have no content. Paths are those of ElementTree, with ``/@name`` or ``/text()``
as a last step.
"""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
from datetime import datetime
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without content (fixed values).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("page")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        last = self.open[-1]
        if len(last):
            last[-1].tail = (last[-1].tail or "") + data
        else:
            last.text = (last.text or "") + data


def tree(html: str | None) -> ET.Element:
    """A page's element tree below one root."""
    reader = _Tree()
    reader.feed(html or "")
    reader.close()
    return reader.root


def said(node: ET.Element, but: tuple[str, ...] = ("script", "style")) -> str:
    """A node's text with single blanks, without that of scripts and styles."""

    def parts(x: ET.Element):
        if x.tag not in but:
            yield x.text or ""
            for child in x:
                yield from parts(child)
                yield child.tail or ""

    return " ".join(" ".join(parts(node)).split())


# --- field rules (H9, H10) ----------------------------------------------------------------------------


def field_value(page: ET.Element, text: str | None, rule: dict) -> str | None:
    """H9: a constant (``value``), or what a ``path`` names (else ``text``), in single blanks, cut by ``regex`` (its group
    value, else its first, else all) and read as a date by ``date_format``; ValueError for a date that cannot be read."""
    if rule.get("value") is not None:
        return rule["value"]
    found = text
    if path := rule.get("path"):
        steps, _, last = path.rpartition("/")
        if last.startswith("@"):
            node = page.find(steps or ".")
            found = None if node is None else node.get(last[1:])
        elif last == "text()":
            node = page.find(steps or ".")
            found = None if node is None else node.text
        else:
            node = page.find(path)
            found = None if node is None else said(node)
    if found is None:
        return None
    found = " ".join(found.split())
    if pattern := rule.get("regex"):
        m = re.search(pattern, found)
        if m is None:
            return None
        found = m["value"] if "value" in m.re.groupindex else m[1] if m.re.groups else m[0]
    if form := rule.get("date_format"):
        found = datetime.strptime((found or "").strip(), form).date().isoformat()
    return (found or "").strip() or None


def fields(html: str | None, url: str | None, rules: dict[str, dict]) -> dict[str, str | None]:
    """The values of all rules; title falls back to the first heading that says something, then to the page's title."""
    page, out = tree(html), {}
    for name, rule in rules.items():
        try:
            out[name] = field_value(page, url if rule.get("of") == "url" else said(page), rule)
        except ValueError:
            out[name] = None
            out["error"] = "document_date_unparseable"
    if not out.get("title"):
        heads = (said(h) for h in page.iter("h1"))
        title = page.find(".//title")
        out["title"] = next((h for h in heads if h), None) or (said(title) if title is not None else None) or None
    return out


def field_rules(pages: DataFrame, rules: dict[str, dict]) -> DataFrame:
    """page_id and a text column for each rule, title and error."""
    names = list(dict.fromkeys([*rules, "title", "error"]))
    kind = "struct<" + ",".join(f"{n}:string" for n in names) + ">"

    @F.pandas_udf(kind)
    def run(html: pd.Series, url: pd.Series) -> pd.DataFrame:
        found = [fields(h, u, rules) for h, u in zip(html, url)]
        return pd.DataFrame({n: [x.get(n) for x in found] for n in names}, dtype=object)

    return pages.select("page_id", run("html", "url").alias("f")).select("page_id", "f.*")


# --- list pages (A8) ----------------------------------------------------------------------------------

_POSTBACK = re.compile(r"__doPostBack\('([^']+)','(Page\$[^']+)'\)")
LIST = "struct<number:int,details:array<string>,fields:map<string,string>,action:string,target:string,argument:string,error:string>"


def list_page(html: str | None, url: str, grid: str = ".//table", detail: str = r"[?&]docid=\d+") -> dict:
    """Page number, addresses of documents, form fields and the event of the next page of a list that posts back.

    ``error``: document_list_not_found, document_page_identity_missing, or document_next_page_not_found where a last
    page is offered but not the next one.
    """
    page = tree(html)
    form = next((f for f in page.iter("form") if f.get("method", "").lower() == "post"), None)
    table = page.find(grid)
    if form is None or table is None:
        return {"error": "document_list_not_found"}
    held = {}
    for x in form.iter():
        name = x.get("name")
        if name is None:
            continue
        if x.tag == "select":
            options = list(x.iter("option"))
            chosen = next((o for o in options if "selected" in o.attrib), options[0] if options else None)
            held[name] = "" if chosen is None else chosen.get("value", "")
        elif x.tag == "textarea" or x.tag == "input" and x.get("type", "").lower() not in ("submit", "button", "image", "checkbox", "radio"):
            held[name] = x.get("value", "")
    links = [a.get("href", "") for a in table.iter("a")]
    details = list(dict.fromkeys(urljoin(url, h) for h in links if re.search(detail, h)))
    events = dict(reversed([(m[2], m[1]) for h in links if (m := _POSTBACK.search(h))]))  # of events told twice the first
    rows = list(table.iter("tr"))
    marks = [s.text or "" for s in rows[-1].iter("span")] if rows else []
    if not details or not marks or not marks[-1].strip().isdigit():
        return {"error": "document_page_identity_missing"}
    number = int(marks[-1])
    argument = f"Page${number + 1}"
    out = {"number": number, "details": details, "fields": held, "action": urljoin(url, form.get("action", ""))}
    if argument in events:
        return {**out, "target": events[argument], "argument": argument}
    return {**out, "error": "document_next_page_not_found"} if "Page$Last" in events else out


def list_pages(pages: DataFrame) -> DataFrame:
    """page_id and what ``list_page`` finds."""
    names = ["number", "details", "fields", "action", "target", "argument", "error"]

    @F.pandas_udf(LIST)
    def run(html: pd.Series, url: pd.Series) -> pd.DataFrame:
        found = [list_page(h, u or "") for h, u in zip(html, url)]
        out = {n: [x.get(n) for x in found] for n in names}
        return pd.DataFrame({**{n: pd.Series(v, dtype=object) for n, v in out.items()}, "number": pd.array(out["number"], "Int32")})

    return pages.select("page_id", run("html", "url").alias("l")).select("page_id", "l.*")


def page_advances(lists: DataFrame, by: str, order: str) -> DataFrame:
    """``lists`` with whether each page's number is that of the page before it in its run and one more (the first: 1)."""
    from pyspark.sql.window import Window

    before = F.lag("number", 1, 0).over(Window.partitionBy(by).orderBy(order))
    return lists.withColumn("advances", F.coalesce(F.col("number") == before + 1, F.lit(False)))


# --- inspection (K10) ---------------------------------------------------------------------------------

#: What may hold an article: elements, and class or id names of content systems; words of links to a next page (fixed values).
BLOCKS = {"article": ("article", None), "TRS_Editor": ("class", "TRS_Editor"), "vF_detail_content": ("class", "vF_detail_content"), "zoom": ("id", "zoom"), "fontzoom": ("id", "fontzoom"), "txt_txt": ("class", "txt_txt"), "UCAP-CONTENT": ("id", "UCAP-CONTENT"), "pages_content": ("class", "pages_content"), "article-content": ("class", "article-content"), "article_content": ("class", "article_content"), "content-text": ("class", "content-text"), "detail-content": ("class", "detail-content")}
NEXT = re.compile(r"\s*(下一页|下页|Next|Next page|›|>)\s*", re.I)
API = re.compile(r"""["']([^"'\s]{1,200}(?:\.json|\.do|\.action|/api/[^"'\s]*)(?:\?[^"'\s]*)?)["']""")
INSPECTED = "struct<forms:array<struct<action:string,method:string,fields:array<string>>>,candidates:array<struct<url:string,text:string,score:int>>,pagination:array<string>,article_blocks:array<struct<selector:string,chars:int,sha256:string>>,api_hints:array<string>>"


def _held_by(node: ET.Element, way: tuple[str, str | None]) -> bool:
    kind, name = way
    return node.tag == "article" if kind == "article" else name in node.get(kind, "").split()


def inspect(html: str | None, url: str | None, detail: str = r"/\d+\.html|/detail|/content|[?&]id=", topic: str = "", ignore: str = "") -> dict:
    """Forms with their visible fields, links that may lead to documents (by score, best first), links to a next
    page, blocks of 100 characters and more, and addresses of data in scripts. Lists are whole: nothing is cut off."""
    page, base = tree(html), url or ""
    home = urlsplit(base).hostname

    def resolve(href: str | None) -> str | None:
        try:
            whole = urldefrag(urljoin(base, (href or "").strip()))[0]
            return whole if urlsplit(whole).scheme in ("http", "https") and urlsplit(whole).hostname else None
        except ValueError:
            return None

    forms = []
    for form in page.iter("form"):
        shown = [x for x in form.iter() if x.tag in ("input", "select", "textarea") and x.get("type", "") not in ("hidden", "submit", "button")]
        forms.append({"action": resolve(form.get("action") or base), "method": form.get("method", "GET").upper(), "fields": [x.get("name", x.get("id", "")) for x in shown]})
    best: dict[str, tuple[int, str]] = {}
    following: dict[str, None] = {}
    for a in page.iter("a"):
        address, text = resolve(a.get("href")) if "href" in a.attrib else None, said(a)
        if address is None or urlsplit(address).hostname != home:
            continue
        if NEXT.fullmatch(text):
            following[address] = None
        if len(text) < 9 or (ignore and re.search(ignore, text)):
            continue
        score = 3 * bool(re.search(detail, address)) + 2 * bool(topic and re.search(topic, text)) + bool(re.search(r"20\d{2}", address))
        if score >= 3 and (address not in best or score > best[address][0]):
            best[address] = (score, text)
    blocks = []
    for selector, way in BLOCKS.items():
        for node in page.iter():
            if _held_by(node, way) and len(text := said(node)) >= 100:
                blocks.append({"selector": selector, "chars": len(text), "sha256": hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()})
    scripts = "\n".join(s.text or "" for s in page.iter("script") if "src" not in s.attrib)
    hints = dict.fromkeys(x for u in API.findall(scripts) if (x := resolve(u)))
    ranked = sorted(best.items(), key=lambda x: -x[1][0])
    return {"forms": forms, "candidates": [{"url": u, "text": t, "score": s} for u, (s, t) in ranked], "pagination": list(following), "article_blocks": blocks, "api_hints": list(hints)}


def inspected(pages: DataFrame, **rules: str) -> DataFrame:
    """page_id and what ``inspect`` finds."""

    @F.pandas_udf("string")
    def run(html: pd.Series, url: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(inspect(h, u, **rules), ensure_ascii=False) for h, u in zip(html, url)])

    return pages.select("page_id", F.from_json(run("html", "url"), INSPECTED).alias("i")).select("page_id", "i.*")
