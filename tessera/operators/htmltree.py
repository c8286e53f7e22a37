"""A small lenient HTML tree (stdlib ``html.parser``) and a CSS selector subset.

This is the per-page helper run inside ``mapInPandas`` by ``extract``. Parsing
rules: void tags close at once, an end tag closes the most recent open element of
that name (unmatched end tags are ignored), nothing is closed implicitly,
script/style/template text and comments are not text. Selectors: type, ``*``,
``.class``, ``#id``, ``[attr]``, ``[attr=v]``, ``[attr~=v]``, ``[attr^=v]``,
``[attr$=v]``, ``[attr*=v]``, descendant and ``>`` child combinators, ``,`` groups.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

# HTML void elements.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
# Elements whose text is not document text.
NON_TEXT = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def iter_elements(self):
        """Descendant elements in document order (self excluded)."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def strings(self):
        """Document text nodes below this element (script/style excluded)."""
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in NON_TEXT:
                stack.extend(reversed(n.children))

    def get_text(self, strip: bool = True) -> str:
        if strip:
            return "".join(s.strip() for s in self.strings() if s.strip())
        return "".join(self.strings())

    def get(self, name, default=None):
        return self.attrs.get(name, default)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        a = {}
        for k, v in attrs:
            a.setdefault(k, "" if v is None else v)
        node = Node(tag, a, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.cur = self.cur.parent

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n is not self.root and n.tag != tag:
            n = n.parent
        if n is not None and n is not self.root:
            self.cur = n.parent

    def handle_data(self, data):
        if self.cur.children and isinstance(self.cur.children[-1], str):
            self.cur.children[-1] += data
        else:
            self.cur.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


_SIMPLE = re.compile(
    r"""([A-Za-z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|"""
    r"""\[\s*([\w:-]+)\s*(?:([~^$*|]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]""")


def _compile_compound(text: str, sel: str):
    out, pos = [], 0
    while pos < len(text):
        m = _SIMPLE.match(text, pos)
        if not m or m.end() == pos:
            raise ValueError(f"unsupported selector: {sel!r}")
        pos = m.end()
        if m.group(1):
            out.append(("tag", m.group(1).lower()))
        elif m.group(2):
            out.append(("class", m.group(2)))
        elif m.group(3):
            out.append(("id", m.group(3)))
        else:
            val = next((g for g in (m.group(6), m.group(7), m.group(8)) if g is not None), None)
            out.append(("attr", m.group(4).lower(), m.group(5), val))
    return out


def compile_selector(sel: str):
    """-> list of alternatives; each is a list of (combinator-to-previous, compound)."""
    groups = []
    for part in sel.split(","):
        words = part.replace(">", " > ").split()
        if not words:
            continue
        steps, comb = [], " "
        for w in words:
            if w == ">":
                comb = ">"
                continue
            steps.append((comb, _compile_compound(w, sel)))
            comb = " "
        groups.append(steps)
    return groups


def _match_compound(n: Node, compound) -> bool:
    for t in compound:
        kind = t[0]
        if kind == "tag":
            if t[1] != "*" and n.tag != t[1]:
                return False
        elif kind == "class":
            if t[1] not in n.attrs.get("class", "").split():
                return False
        elif kind == "id":
            if n.attrs.get("id") != t[1]:
                return False
        else:
            _, name, op, val = t
            if name not in n.attrs:
                return False
            have = n.attrs[name]
            if op is None:
                continue
            if op == "=" and have != val:
                return False
            if op == "~=" and val not in have.split():
                return False
            if op == "^=" and not (val and have.startswith(val)):
                return False
            if op == "$=" and not (val and have.endswith(val)):
                return False
            if op == "*=" and not (val and val in have):
                return False
            if op == "|=" and not (have == val or have.startswith(val + "-")):
                return False
    return True


def _match_steps(n: Node, steps, i: int) -> bool:
    """Does element ``n`` match steps[:i+1]? Ancestors are looked up in the whole
    document, as CSS matching does for ``element.select``."""
    comb, compound = steps[i]
    if not _match_compound(n, compound):
        return False
    if i == 0:
        return True
    p = n.parent
    if comb == ">":
        return p is not None and p.parent is not None and _match_steps(p, steps, i - 1)
    while p is not None and p.parent is not None:
        if _match_steps(p, steps, i - 1):
            return True
        p = p.parent
    return False


def select(scope: Node, compiled) -> list[Node]:
    """All descendants of ``scope`` matching any alternative, in document order."""
    out = []
    for n in scope.iter_elements():
        for steps in compiled:
            if _match_steps(n, steps, len(steps) - 1):
                out.append(n)
                break
    return out


def select_one(scope: Node, compiled):
    for n in scope.iter_elements():
        for steps in compiled:
            if _match_steps(n, steps, len(steps) - 1):
                return n
    return None
