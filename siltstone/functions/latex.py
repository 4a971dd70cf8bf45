"""LaTeX in captions to readable Unicode, as an Arrow-batched function.

One reader goes through the text from left to right: a command takes the groups that it needs and gives
text, scripts become small letters where all of their characters have one, marks of formulas and braces
go, and a command of no meaning here goes too. Spaces are put right as the text is written.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MACRON = "̄"

# --- Fixed values: what commands, macros and scripts stand for.
GREEK = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "varepsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ", "vartheta": "ϑ",
    "iota": "ι", "kappa": "κ", "lambda": "λ", "mu": "μ", "nu": "ν", "xi": "ξ", "pi": "π", "rho": "ρ", "varrho": "ϱ", "sigma": "σ", "tau": "τ",
    "upsilon": "υ", "phi": "φ", "varphi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω",
    "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ", "Upsilon": "Υ", "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω",
}
SYMBOLS = {
    "rightarrow": "→", "to": "→", "longrightarrow": "⟶", "leftarrow": "←", "Rightarrow": "⇒", "Leftarrow": "⇐", "leftrightarrow": "↔", "mapsto": "↦",
    "pm": "±", "mp": "∓", "times": "×", "cdot": "·", "ast": "∗", "star": "⋆", "circ": "∘", "bullet": "•",
    "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "approx": "≈", "simeq": "≃", "sim": "∼", "equiv": "≡", "propto": "∝", "ll": "≪", "gg": "≫",
    "infty": "∞", "partial": "∂", "nabla": "∇", "in": "∈", "notin": "∉", "subset": "⊂", "cap": "∩", "cup": "∪", "forall": "∀", "exists": "∃",
    "langle": "⟨", "rangle": "⟩", "ell": "ℓ", "hbar": "ℏ", "dagger": "†", "prime": "′", "emptyset": "∅", "perp": "⊥", "parallel": "∥",
    "oplus": "⊕", "otimes": "⊗", "sum": "∑", "prod": "∏", "int": "∫",
}
MACROS = {
    "GeV": "GeV", "TeV": "TeV", "MeV": "MeV", "keV": "keV", "eV": "eV", "ifb": "fb^{-1}", "fbinv": "fb^{-1}", "ipb": "pb^{-1}", "fb": "fb", "pb": "pb",
    "mX": "m_{X}", "mH": "m_{H}", "mgg": "m_{γγ}", "mj": "m_{j}", "mll": "m_{ll}", "mtt": "m_{tt}", "ptop": "p_{T}", "pt": "p_{T}", "MET": "E_{T}^{miss}",
    "Zp": "Z′", "Zprime": "Z′", "Zboson": "Z", "Wboson": "W", "qqbar": "qq̄", "ttbar": "tt̄", "bbbar": "bb̄",
    "BRxgg": "BR(X→γγ)", "BRhgg": "BR(H→γγ)", "xsecBR": "σ×BR", "ddtcorr": "DDT-corrected", "yv": "y", "yz": "y_{0}", "pp": "pp", "sqrts": "√s",
}
SUPERSCRIPTS = str.maketrans("0123456789+-=()abcdefghijklmnoprstuvwxyz", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ")
SUBSCRIPTS = str.maketrans("0123456789+-=()aehijklmnoprstuvx", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎ₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓ")
# Commands whose one group stays, goes, or gets a bar, and those that bar the letter after them.
FONTS = {"mathrm", "textrm", "text", "mbox", "hbox", "mathcal", "mathbf", "mathit", "mathsf", "boldsymbol", "operatorname", "rm", "it", "bf", "num"}
POINTERS = {"cite", "citep", "citet", "ref", "eqref", "label", "autoref"}
OVER_GROUPS, OVER_LETTERS = {"bar", "overline"}, {"bar", "hat", "vec", "tilde", "dot"}
SPACES = {"quad", "qquad", "thinspace"}

TRIGGER = r"[\\$^_~]|--"
MARKS = ("\\", "$", "^", "_", "~", "--")


def barred(text: str) -> str:
    text = text.strip()
    return text[:1] + MACRON + text[1:] if text else ""


class Reader:
    """Reads a text once, from left to right."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self, allowed) -> str:
        """The run of characters from here on that are allowed."""
        start = self.at
        while self.at < len(self.text) and allowed(self.text[self.at]):
            self.at += 1
        return self.text[start : self.at]

    def groups(self, n: int) -> list[str] | None:
        """The contents of n groups in braces, read; if there are not so many here, none is taken."""
        start, found = self.at, []
        for _ in range(n):
            self.take(str.isspace)
            if self.peek() != "{":
                self.at = start
                return None
            self.at += 1
            found.append(self.run(inside=True))
        return found

    def run(self, inside: bool = False) -> str:
        """The text up to the end, or to the brace that closes the group."""
        out = []
        while self.at < len(self.text):
            if self.peek() == "}":
                self.at += 1
                if inside:
                    break
            else:
                out.append(self.one())
        return "".join(out)

    def one(self) -> str:
        """What the next thing stands for: a command, a script, a group or a character."""
        c = self.peek()
        self.at += 1
        if c == "\\":
            return self.command()
        if c in "^_":
            return self.script(c)
        if c == "{":
            return self.run(inside=True)
        return {"$": "", "~": " "}.get(c, c)

    def script(self, kind: str) -> str:
        after = self.peek()
        if not after or after.isspace() or after == "}":
            return kind
        text, table = self.one(), SUPERSCRIPTS if kind == "^" else SUBSCRIPTS
        return text.translate(table) if text and all(ord(c) in table for c in text) else text

    def command(self) -> str:
        name = self.take(lambda c: c.isascii() and c.isalpha())
        if not name:
            return self.sign()
        if name in MACROS:
            return Reader(MACROS[name]).run()
        if name in GREEK or name in SYMBOLS:
            return GREEK.get(name) or SYMBOLS[name]
        if name in SPACES:
            return " "
        if name == "looseness":
            self.take(lambda c: c.isspace() or c in "=-")
            self.take(str.isdigit)
        elif name in ("SI", "frac") and (two := self.groups(2)):
            return (" " if name == "SI" else "/").join(two)
        elif name in FONTS | POINTERS | OVER_GROUPS | {"sqrt"} and (group := self.groups(1)):
            return "" if name in POINTERS else barred(group[0]) if name in OVER_GROUPS else "√" + group[0] if name == "sqrt" else group[0]
        elif name in OVER_LETTERS | {"sqrt"} and self.peek().isspace():
            self.take(str.isspace)
            if name == "sqrt" and self.peek():
                return "√"
            if self.peek().isascii() and self.peek().isalpha():
                return barred(self.one())
            return " "
        return ""

    def sign(self) -> str:
        """A backslash before what isn't a letter."""
        c = self.peek()
        if c and c in ",;:! ":
            self.at += 1
            return " "
        if c and c in "%&#_":
            self.at += 1
            return c
        if c and c in "$()":
            self.at += 1
            return ""
        if c == "=":
            self.at += 1
            self.take(str.isspace)
            return barred(self.one()) if self.peek() else ""
        return "\\"


def tidied(text: str) -> str:
    """Runs of blanks as one, none before closing or after opening signs; two or three hyphens as a dash."""
    out: list[str] = []
    gap = hyphens = 0

    def write(c: str) -> None:
        nonlocal gap
        if gap and c not in ",;.)]" and (not out or out[-1] not in "(["):
            out.append(" ")
        gap = 0
        out.append(c)

    for c in text + "\0":
        if c == "-":
            hyphens += 1
            continue
        for _ in range(hyphens // 3):
            write("—")
        if hyphens % 3:
            write("-–"[hyphens % 3 - 1])
        hyphens = 0
        if c in " \t\r\n":
            gap = 1
        elif c != "\0":
            write(c)
    return "".join(out) + " " * (gap and (not out or out[-1] not in "(["))


def clean(text: str | None) -> str | None:
    """One run of text; text without a trace of LaTeX is returned as it is."""
    if not text or not any(m in text for m in MARKS):
        return text
    return tidied(Reader(text).run())


@F.pandas_udf(StringType())
def _cleaned(s: pd.Series) -> pd.Series:
    return s.map(clean, na_action="ignore")


def clean_text(column: Column | str) -> Column:
    """``clean`` over a column. Only texts with a trace of LaTeX go through Python."""
    text = F.col(column) if isinstance(column, str) else column
    marked = F.rlike(text, F.lit(TRIGGER))
    return F.when(marked, _cleaned(F.when(marked, text))).otherwise(text)


def residual_count(prose: str):
    """How many raw LaTeX marks are left in prose: citations, and dollars that aren't escaped."""
    return F.regexp_count(F.col(prose), F.lit(r"\\cite|(?<!\\)\$"))
