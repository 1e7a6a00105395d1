"""Finding the query panels of one HTML report; the helper that runs inside Python tasks."""

from __future__ import annotations

import re
from html.parser import HTMLParser

# The markup families and the caption that goes before a panel's title.
TOGGLE, PROOF, QUERY = "dax-toggle", "dax-proof", "dax-query"
CAPTION = re.compile(r"^\s*View DAX Query\s*[—–-]?\s*")
_HEADINGS = ("h1", "h2", "h3")


class PanelReader(HTMLParser):
    """Collects (family, label, body) in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.panels: list[tuple[str, str, str]] = []
        self._divs: list[str | None] = []      # open divs, a family name where one starts
        self._proof = False
        self._screen = ""
        self._texts = {"heading": "", TOGGLE: "", QUERY: ""}
        self._sink: str | None = None          # which text the next data belongs to
        self._body: list[str] | None = None

    def _family(self) -> str | None:
        if self._proof:
            return PROOF
        return next((f for f in (TOGGLE, QUERY) if f in self._divs), None)

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        classes = (attributes.get("class") or "").split()
        if tag in _HEADINGS:
            self._sink, self._texts["heading"] = "heading", ""
        elif tag == "section" and attributes.get("data-screen-label"):
            self._screen = attributes["data-screen-label"]
        elif tag == "details":
            self._proof = self._proof or PROOF in classes
        elif tag == "div":
            family = next((f for f in (TOGGLE, QUERY) if f in classes), None)
            if family:
                self._texts[family] = ""
            self._divs.append(family)
        elif tag == "span" and self._sink != "heading":
            if TOGGLE in self._divs:
                self._sink = TOGGLE
            elif QUERY in self._divs and "dax-title" in classes:
                self._sink = QUERY
        elif tag == "pre" and self._family():
            self._body = []

    def handle_endtag(self, tag):
        if tag == "pre" and self._body is not None:
            self._close_panel("".join(self._body).strip())
            self._body = None
        elif tag == "details":
            self._proof = False
        elif tag == "div" and self._divs:
            self._divs.pop()
        elif tag in _HEADINGS or (tag == "span" and self._sink != "heading"):
            self._sink = None

    def handle_data(self, data):
        if self._body is not None:
            self._body.append(data)
        elif self._sink:
            self._texts[self._sink] += data

    def _close_panel(self, body: str) -> None:
        family = self._family()
        if not body or family is None:
            return
        heading = self._texts["heading"].strip()
        own = {PROOF: self._screen, QUERY: self._texts[QUERY].strip(),
               TOGGLE: CAPTION.sub("", self._texts[TOGGLE]).strip()}[family]
        self.panels.append((family, own or heading or family, body))


def read_panels(html: str | None) -> list[tuple[str, str, str]]:
    reader = PanelReader()
    reader.feed(html or "")
    reader.close()
    return reader.panels
