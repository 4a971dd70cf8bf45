"""A small tree for mixed content: a node's kids are texts and nodes in one list.

Unwrapping a node is splicing its kids into its parent's list, so no text has to be moved between
siblings. Names are local names; an attribute keeps the prefix ``xlink`` or ``xml`` and no other.
Comments and processing instructions go; a document type is read over.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr


class Node:
    __slots__ = ("attrs", "kids", "name")

    def __init__(self, name: str, attrs: dict[str, str] | None = None, *kids: Node | str):
        self.name, self.attrs, self.kids = name, attrs or {}, [k for k in kids if k != ""]

    def nodes(self, *names: str) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node) and (not names or k.name in names)]

    def walk(self, *names: str) -> Iterator[Node]:
        """This node and those below it, in document order."""
        todo = [self]
        while todo:
            n = todo.pop()
            if not names or n.name in names:
                yield n
            if len(n.kids) == 1:  # mostly a paragraph's text
                if n.kids[0].__class__ is Node:
                    todo.append(n.kids[0])
            elif n.kids:
                todo += [k for k in reversed(n.kids) if k.__class__ is Node]

    def first(self, *names: str) -> Node | None:
        return next((n for n in self.walk(*names) if n is not self), None)

    def text(self) -> str:
        return "".join(k if isinstance(k, str) else k.text() for k in self.kids)

    def plain(self) -> str:
        return " ".join(self.text().split())

    def href(self) -> str:
        return self.attrs.get("xlink:href") or self.attrs.get("href") or ""

    def relink(self, href: str) -> None:
        self.attrs.pop("href", None)
        self.attrs["xlink:href"] = href

    def rewrite(self, change: Callable[[Node], list[Node | str] | None]) -> Node:
        """Replaces nodes below, from the deepest up: ``change`` gives what to put in a node's place, None to leave it."""
        if len(self.kids) == 1 and self.kids[0].__class__ is str and self.kids[0]:
            return self
        out: list[Node | str] = []
        for k in self.kids:
            if isinstance(k, Node):
                k.rewrite(change)
                to = change(k)
                out += [k] if to is None else to
            else:
                out.append(k)
        self.kids = joined(out)
        return self


def joined(kids: list[Node | str]) -> list[Node | str]:
    """Texts that have come to stand side by side made one."""
    out: list[Node | str] = []
    for k in kids:
        if isinstance(k, str) and out and isinstance(out[-1], str):
            out[-1] += k
        elif k != "":
            out.append(k)
    return out


# A tag, or what has none of the text in it; a CDATA section's content is text.
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)|<\?.*?(?:\?>|\Z)|<![A-Za-z][^\[>]*(?:\[.*?\]\s*)?>|<(?P<end>/?)(?P<name>[A-Za-z_][\w:.-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z_][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def recovered(text: str) -> Node:
    """The tree of a damaged document, as far as it can be told.

    An end that closes nothing open is passed over; one that closes an outer element closes those
    inside too; what is open at the end ends there; a reference that isn't known stays as it is written; a stray
    angle bracket is text. Raises ValueError where there is no element at all.
    """
    root = Node("")
    stack, at = [root], 0

    def write(data: str) -> None:
        kids = stack[-1].kids
        if data and kids and isinstance(kids[-1], str):
            kids[-1] += data
        elif data:
            kids.append(data)

    for m in PIECE.finditer(text):
        write(html.unescape(text[at : m.start()]))
        at = m.end()
        if m["raw"] is not None:
            write(m["raw"])
        if not m["name"]:
            continue
        name = m["name"].rpartition(":")[2]
        if m["end"]:
            if any(n.name == name for n in stack[1:]):
                while stack.pop().name != name:
                    pass
            continue
        attrs = {k if k.startswith(("xlink:", "xml:")) else k.rpartition(":")[2]: html.unescape(a or b) for k, a, b in ATTRIBUTE.findall(m["rest"]) if not k.startswith("xmlns")}
        stack[-1].kids.append(Node(name, attrs))
        if not m["rest"].rstrip().endswith("/"):
            stack.append(stack[-1].kids[-1])
    write(html.unescape(text[at:]))
    if not root.nodes():
        raise ValueError("not well formed: no element")
    return root.nodes()[0]


def parse(text: str, recover: bool = False) -> Node:
    """The tree of a document. Where it isn't well formed, what can be told of it with ``recover``, else ValueError."""
    root = Node("")
    stack = [root]

    def local(name: str) -> str:
        return name if name.startswith(("xlink:", "xml:")) else name.rpartition(":")[2]

    def start(name, attrs):
        node = Node(name.rpartition(":")[2], {local(k): v for k, v in attrs.items() if not k.startswith("xmlns")})
        stack[-1].kids.append(node)
        stack.append(node)

    def characters(data):
        kids = stack[-1].kids
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)

    p = expat.ParserCreate()
    p.buffer_text = True
    p.StartElementHandler, p.CharacterDataHandler = start, characters
    p.EndElementHandler = lambda _: stack.pop()
    p.SetParamEntityParsing(expat.XML_PARAM_ENTITY_PARSING_NEVER)
    try:
        p.Parse(text, True)
    except expat.ExpatError as e:
        if recover:
            return recovered(text)
        raise ValueError(f"not well formed: {e}") from e
    return root.nodes()[0]


def _write(node: Node, out: list[str]) -> None:
    name = f"mml:{node.name}" if node.name in MATH else node.name
    attrs = "".join([f" {k}={quoteattr(v)}" for k, v in node.attrs.items()]) if node.attrs else ""
    out.append(f"<{name}{attrs}>")
    start = len(out)
    for k in node.kids:
        if k.__class__ is not str:
            _write(k, out)
        elif k:
            out.append(escape(k))
    if len(out) > start:
        out.append(f"</{name}>")
    else:
        out[-1] = f"<{name}{attrs}/>"


def serialise(node: Node) -> str:
    out: list[str] = []
    _write(node, out)
    return "".join(out)


# Elements of mathematics, which the house form writes with a prefix.
MATH = set("math mi mn mo mtext mspace ms mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mlabeledtr maction semantics annotation none mprescripts".split())
