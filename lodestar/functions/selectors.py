"""Element selectors over HTML text: a tag scanner that keeps the stack of
open elements, and the small part of the CSS selector language that result
pages need."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))

_PART = re.compile(r"""\s*(>|,)\s*|(\s+)|([A-Za-z][\w-]*|\*)|\#([\w-]+)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:([~^$*]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]""")


@dataclass
class Step:
    """One element test of a selector and how it hangs on the step before:
    ``" "`` (any depth) or ``">"`` (child)."""

    joined: str = " "
    tag: str | None = None
    id: str | None = None
    classes: frozenset[str] = frozenset()
    attrs: tuple[tuple[str, str, str], ...] = ()

    def fits(self, element: "Element") -> bool:
        if self.tag not in (None, "*", element.tag) or (self.id is not None and element.attrs.get("id") != self.id):
            return False
        return self.classes <= element.classes and all(_holds(element.attrs, *a) for a in self.attrs)


def _holds(attrs: dict[str, str], name: str, how: str, value: str) -> bool:
    have = attrs.get(name)
    if have is None:
        return False
    return {"": True, "=": have == value, "~=": value in have.split(), "^=": bool(value) and have.startswith(value),
            "$=": bool(value) and have.endswith(value), "*=": bool(value) and value in have}[how]


@dataclass
class Element:
    tag: str
    attrs: dict[str, str]
    classes: frozenset[str] = field(default_factory=frozenset)


def parse_selector(text: str) -> list[list[Step]]:
    """``tag``, ``#id``, ``.class``, ``[attr]``, ``[attr="value"]`` (also
    ``~= ^= $= *=``), joined by blanks or ``>``; a comma gives alternatives.
    Anything else is an error here, on the driver."""
    chains, steps, joined, current = [], [], " ", None
    at, text = 0, text.strip()
    while at < len(text):
        m = _PART.match(text, at)
        if not m or m.end() == at:
            raise ValueError(f"selector {text!r}: not understood from {text[at:]!r}")
        sign, blank, tag, ident, klass, name, how, *values = m.groups()
        at = m.end()
        if sign or blank:
            if current is None:
                raise ValueError(f"selector {text!r}: nothing before {sign or blank!r}")
            steps.append(current)
            current, joined = None, ">" if sign == ">" else " "
            if sign == ",":
                chains.append(steps)
                steps = []
            continue
        if current is None:
            current = Step(joined)
        if tag:
            current.tag = tag.lower()
        elif ident:
            current.id = ident
        elif klass:
            current.classes |= {klass}
        else:
            current.attrs += ((name.lower(), how or "", next((v for v in values if v is not None), "")),)
    if current is None:
        raise ValueError(f"selector {text!r}: nothing at its end")
    return [*chains, [*steps, current]]


def matches(chains: list[list[Step]], stack: list[Element]) -> bool:
    """Whether the innermost open element fits one of the chains."""
    return any(_fits(chain, len(chain) - 1, stack, len(stack) - 1) for chain in chains)


def _fits(chain: list[Step], step: int, stack: list[Element], at: int) -> bool:
    if not chain[step].fits(stack[at]):
        return False
    if step == 0:
        return True
    above = (at - 1,) if chain[step].joined == ">" else range(at - 1, -1, -1)
    return any(i >= 0 and _fits(chain, step - 1, stack, i) for i in above)


class Records(HTMLParser):
    """Reads one page: a record for each element that ``block`` selects, in
    document order and nested ones too, with the first match of every field
    inside it: an attribute, or all text below the element."""

    def __init__(self, block: list[list[Step]], fields: list[tuple[str, list[list[Step]], str | None]]):
        super().__init__(convert_charrefs=True)
        self.block, self.fields = block, fields
        self.stack: list[Element] = []
        self.open: Counter[str] = Counter()
        self.records: list[dict[str, object]] = []
        self.blocks: list[tuple[int, dict]] = []          # (depth, record) of the open blocks
        self.reading: list[tuple[int, list[str]]] = []    # (depth, pieces) of the texts being read

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named: dict[str, str] = {}
        for name, value in attrs:
            named.setdefault(name, value or "")
        self.stack.append(Element(tag, named, frozenset(named.get("class", "").split())))
        self.open[tag] += 1
        depth = len(self.stack)
        wanted = [f for f in self.fields if any(f[0] not in r for _, r in self.blocks)]
        for name, chains, attr in wanted:
            if matches(chains, self.stack):
                if attr is None:
                    value: object = []
                    self.reading.append((depth, value))
                else:
                    value = named.get(attr)
                for _, record in self.blocks:
                    record.setdefault(name, value)
        if matches(self.block, self.stack):
            record = {}
            self.records.append(record)
            self.blocks.append((depth, record))
        if tag in VOID:
            self._close(depth - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes void elements only, as browsers read it

    def handle_endtag(self, tag: str) -> None:
        if not self.open[tag]:
            return  # closes nothing
        at = len(self.stack) - 1
        while self.stack[at].tag != tag:
            at -= 1
        self._close(at)

    def _close(self, depth: int) -> None:
        for element in self.stack[depth:]:
            self.open[element.tag] -= 1
        del self.stack[depth:]
        while self.blocks and self.blocks[-1][0] > depth:
            self.blocks.pop()
        while self.reading and self.reading[-1][0] > depth:
            self.reading.pop()

    def handle_data(self, data: str) -> None:
        if self.reading and not (self.stack and self.stack[-1].tag in HIDDEN):
            for _, pieces in self.reading:
                pieces.append(data)


def select_records(html: str, block: list[list[Step]], fields: list[tuple[str, list[list[Step]], str | None]]
                   ) -> tuple[list[dict[str, str | None]], str | None]:
    """(records, error) of one page: what was read before a mark-up error
    stays, beside the error."""
    reader, error = Records(block, fields), None
    try:
        reader.feed(html)
        reader.close()
    except (AssertionError, ValueError) as e:  # broken declarations
        error = f"{type(e).__name__}: {e}"
    return [{name: "".join(r[name]) if isinstance(r.get(name), list) else r.get(name) for name, _, _ in fields}
            for r in reader.records], error
