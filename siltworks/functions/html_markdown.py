"""HTML as Markdown by a stack of open elements, over Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

BREAKS = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "table", "tr", "figure", "form", "dl", "dt", "dd"}
MARKS = {"strong": "**", "b": "**", "em": "*", "i": "*", "del": "~~", "s": "~~"}
HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}
UNREAD = {"script", "style", "template", "noscript", "title", "head"}
SCHEMES = re.compile(r"(?:https?|mailto):", re.IGNORECASE)


class Frame:
    """An open element and what has been written inside it."""

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.parts, self.items, self.rows = tag, attrs, [], 0, []


class Writer(HTMLParser):
    """Closing tags close what is open inside them; those that nothing opened, and what the end cuts off, do no harm."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Frame("", {})]

    def inside(self, *tags: str) -> bool:
        return any(f.tag in tags for f in self.stack)

    def write(self, text: str) -> None:
        self.stack[-1].parts.append(text)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.write("\n")
        elif tag == "hr":
            self.write("\n\n---\n\n")
        elif tag == "img":
            values = dict(attrs)
            if SCHEMES.match(values.get("src") or ""):
                self.write(f"![{self.label(values.get('alt') or '')}]({values['src'].replace(' ', '%20')})")
        elif tag not in ("meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"):
            if tag in ("p", "li", "tr", "td", "th"):
                self.implied_end(tag)
            self.stack.append(Frame(tag, dict(attrs)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.stack[-1].tag == tag:
            self.close_top()

    def implied_end(self, tag: str) -> None:
        """A list item or cell ends the one before it, a paragraph that is open too."""
        scope = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(tag, ())
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in scope or (tag == "p" and self.stack[depth].tag != "p"):
                return
            if self.stack[depth].tag == tag or (tag in ("td", "th") and self.stack[depth].tag in ("td", "th")):
                while len(self.stack) > depth:
                    self.close_top()
                return

    def handle_endtag(self, tag: str) -> None:
        if any(f.tag == tag for f in self.stack[1:]):
            while self.stack[-1].tag != tag:
                self.close_top()
            self.close_top()

    def handle_data(self, data: str) -> None:
        if self.inside("pre"):
            self.write(data)
        elif not self.inside(*UNREAD):
            data = re.sub(r"[ \t\r\n\f]+", " ", data)
            self.write(data if self.inside("code") else re.sub(r"([\\`*_\[\]<>])", r"\\\1", data))

    @staticmethod
    def label(text: str) -> str:
        return re.sub(r"\s+", " ", text).replace("[", "\\[").replace("]", "\\]").strip()

    def close_top(self) -> None:
        frame = self.stack.pop()
        self.write(self.rendered(frame, "".join(frame.parts)))

    def rendered(self, frame: Frame, text: str) -> str:
        tag, bare = frame.tag, text.strip()
        if tag in UNREAD:
            return ""
        if tag != "pre" and self.inside("pre"):
            return text
        if tag in HEADINGS:
            return f"\n\n{HEADINGS[tag]}{' '.join(bare.split())}\n\n" if bare else ""
        if tag in MARKS:
            # a mark that nobody closed does not run over paragraphs
            return text.replace(bare, f"{MARKS[tag]}{bare}{MARKS[tag]}", 1) if bare and "\n\n" not in bare else text
        if tag == "pre":
            ticks = "`" * max(3, 1 + max((len(m) for m in re.findall("`+", text)), default=0))
            return f"\n\n{ticks}\n{text.strip(chr(10))}\n{ticks}\n\n"
        if tag == "code":
            ticks = "`" * (1 + max((len(m) for m in re.findall("`+", text)), default=0))
            return f"{ticks}{' ' if bare[:1] == '`' else ''}{bare}{' ' if bare[-1:] == '`' else ''}{ticks}" if bare else ""
        if tag == "a":
            url = (frame.attrs.get("href") or "").strip()
            return f"[{' '.join(bare.split())}]({url.replace(' ', '%20')})" if bare and "\n\n" not in bare and SCHEMES.match(url) else text
        if tag == "blockquote":
            return "\n\n" + "\n".join(f"> {line}".rstrip() for line in tidy(text).split("\n")) + "\n\n" if bare else ""
        if tag == "li":
            parent = next((f for f in reversed(self.stack) if f.tag in ("ul", "ol")), None)
            if parent is not None:
                parent.items += 1
            mark = f"{parent.items}. " if parent is not None and parent.tag == "ol" else "- "
            return "\n" + mark + tidy(text).replace("\n", "\n" + " " * len(mark)) if bare else ""
        if tag in ("ul", "ol"):
            nested = self.inside("li")
            return f"\n{tidy(text)}\n" if nested else f"\n\n{tidy(text)}\n\n"
        table = next((f for f in reversed(self.stack) if f.tag == "table"), None)
        if table is not None and tag in ("td", "th"):
            # cells of a row that is still open stand behind the rows that are closed
            row = next(f for f in reversed(self.stack) if f.tag in ("tr", "table"))
            row.rows.append(" ".join(bare.replace("|", "\\|").split()))
            return ""
        if table is not None and tag == "tr":
            table.rows.append(frame.rows)
        if tag == "table":
            rows = [x if isinstance(x, list) else [x] for x in frame.rows if x]
            width = max(map(len, rows), default=0)
            lines = [f"| {' | '.join(x + [''] * (width - len(x)))} |" for x in rows]
            return "\n\n".join(["", text, "\n".join([*lines[:1], "|" + " --- |" * width, *lines[1:]]) if lines else "", ""])
        return f"\n\n{text}\n\n" if tag in BREAKS else text

    def finish(self) -> str:
        self.close()
        while len(self.stack) > 1:
            self.close_top()
        return tidy("".join(self.stack[0].parts))


def tidy(text: str) -> str:
    """No blanks at line ends, no more than one empty line, none at the ends. Code keeps its lines."""
    out, fence, empty = [], None, False
    for line in text.split("\n"):
        ticks = re.match(r"\s*(`{3,})\s*$", line)
        if ticks and fence is None:
            fence = ticks[1]
        elif ticks and ticks[1] == fence:
            fence = None
        elif fence is None:
            line = line.rstrip() if line[:1] == " " and re.match(r" +(?:[-*>]|\d+\.) |  ", line) else line.strip()
        if line or fence is not None:
            out.append(line)
            empty = False
        elif out and not empty:
            out.append("")
            empty = True
    while out and not out[-1]:
        out.pop()
    return "\n".join(out)


def to_markdown(html: str | None) -> str:
    writer = Writer()
    writer.feed(html or "")
    return writer.finish()


def html_markdown(df: DataFrame, key: str, html: str) -> DataFrame:
    """Rows (key, markdown); a null page gives an empty text."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to_markdown(h) for h in b.column(1).to_pylist()], pa.string())], [key, "markdown"])

    return df.select(key, html).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, markdown string")
