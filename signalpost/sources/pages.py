"""Articles and links from stored web pages."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements without an end tag, and elements whose text is never shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style"}


class _Fields(HTMLParser):
    """Texts of the elements that rules name; a rule is ``[inside ]tag[.class]`` or ``[inside ]tag[#id]``."""

    def __init__(self, rules: dict[str, str], drop: list[str]):
        super().__init__(convert_charrefs=True)
        self.rules = {name: [self._selector(s) for s in rule.split()] for name, rule in rules.items()}
        self.drop = [self._selector(s) for s in drop]
        self.found: dict[str, list[str]] = {name: [] for name in rules}
        self.open: list[tuple[str, set[str]]] = []  # tag, and its marks: classes with a dot, the id with a hash

    @staticmethod
    def _selector(text: str) -> tuple[str, str]:
        at = min((text.index(sign) for sign in ".#" if sign in text), default=len(text))
        return text[:at], text[at:]

    @staticmethod
    def _fits(element: tuple[str, set[str]], selector: tuple[str, str]) -> bool:
        return selector[0] in ("", element[0]) and (not selector[1] or selector[1] in element[1])

    def _inside(self, chain: list[tuple[str, str]]) -> bool:
        wanted = list(chain)
        for element in self.open:
            if wanted and self._fits(element, wanted[0]):
                wanted.pop(0)
        return not wanted

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        if tag == "p":  # a new paragraph ends an open one
            self._close("p")
        given = dict(attrs)
        marks = {f".{c}" for c in (given.get("class") or "").split()}
        self.open.append((tag, marks | {f"#{given['id']}"} if given.get("id") else marks))
        for name, chain in self.rules.items():
            if self._fits(self.open[-1], chain[-1]) and self._inside(chain):
                self.found[name].append("")

    def _close(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        if any(e[0] in HIDDEN or any(self._fits(e, d) for d in self.drop) for e in self.open):
            return
        for name, chain in self.rules.items():
            if self.found[name] and self._inside(chain):
                self.found[name][-1] += data


def extract_pages(df: DataFrame, html: str, rules: dict[str, str], drop: list[str], missing: str = "",
                  joiner: str = "\n", first_only: tuple[str, ...] = ("title",)) -> DataFrame:
    """Article fields of each page; several matches are joined, a missing element gives ``missing``.

    The other columns are kept and stay in their task.  Pages are parsed independently by a plain function of one row, of which Spark sends about
    a hundred at a time, so a worker's memory grows neither with the table nor with the size of an Arrow batch.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != html]
    fields = T.StructType([T.StructField(name, T.StringType()) for name in rules])

    def parse(text: str | None) -> tuple[str, ...]:
        page = _Fields(rules, drop)
        page.feed(text or "")
        page.close()
        out = []
        for name in rules:
            parts = [p for p in (" ".join(t.split()) for t in page.found[name]) if p]
            parts = parts[:1] if name in first_only else parts
            out.append(joiner.join(parts) or missing)
        return tuple(out)

    parsed = df.select(*kept, F.udf(parse, fields, useArrow=False)(F.col(f"`{html}`")).alias("_fields"))
    return parsed.select(*kept, *[F.col("_fields").getField(name).alias(name) for name in rules])


def extract_links(df: DataFrame, html: str, url: str, region: str = r"(?s)<nav>(.*?)</nav>",
                  anchor: str = r'<a href="([^"]*)">([^<]*)</a>') -> DataFrame:
    """(link, title) pairs of a listing page; links that start with ``/`` get the page's site."""
    kept = [c for c in df.columns if c != html]
    part = F.regexp_extract(F.col(html), region, 1)
    site = F.regexp_extract(F.col(url), r"^([a-z]+://[^/?#]+)", 1)
    rows = df.select(*kept, F.posexplode(F.arrays_zip(
        F.regexp_extract_all(part, F.lit(anchor), F.lit(1)).alias("link"),
        F.regexp_extract_all(part, F.lit(anchor), F.lit(2)).alias("title"))).alias("pos", "a"))
    link = F.col("a")["link"]
    return rows.select(*kept, "pos", F.when(F.startswith(link, F.lit("/")), F.concat(site, link)).otherwise(link).alias("link"),
                       F.col("a")["title"].alias("title"))
