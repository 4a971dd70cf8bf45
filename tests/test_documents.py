import gzip
import io
import sys
import tarfile
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions.latex import clean
from siltstone.operators import documents, fidelity
from siltstone.operators.foreign import from_publisher, from_tei, source_journal
from siltstone.operators.house import body_latex, front_latex, latex_spans, measure, orphan_figures, prose, residual, to_house, wire
from siltstone.operators.tree import parse, serialise
from siltstone.sources.archives import is_jats, kind, pick_figures, read_members, transform_for, unzipped

JATS = """<!DOCTYPE pmc-articleset PUBLIC "x" "y"><pmc-articleset><article><!-- c --><front><journal-meta><issn>1</issn><journal-title>J</journal-title></journal-meta><article-meta>
<permissions><license><p>At http://creativecommons.org/licenses/by/4.0 see</p></license></permissions><contrib-group><contrib><name/></contrib></contrib-group><contrib-group content-type="Editor"><contrib/></contrib-group>
<aff>a</aff><aff id="aff1">b</aff><title-group><article-title>T &amp; x</article-title></title-group><self-uri xmlns:xlink="http://www.w3.org/1999/xlink" xlink:href="me.pdf"/></article-meta></front>
<body xmlns:xlink="http://www.w3.org/1999/xlink"><p>See <ext-link xlink:href="10.1234/ab">d</ext-link> and <ext-link xlink:href="a search">words</ext-link> tail $E=mc^2$ \\cite{b1, q7}</p>
<fig id="f"><alternatives><graphic xlink:href="a.gif"/><graphic xlink:href="x/a.jpg"/></alternatives></fig><disp-formula><alternatives><graphic xlink:href="m.png"/><tex-math>$x$</tex-math></alternatives></disp-formula>
<table-wrap><table><tgroup><colspec colname="c1"/><colspec colname="c2"/><thead><row><entry namest="c1" nameend="c2">H</entry></row></thead><tbody><row><entry>1</entry><entry align="left">2</entry></row></tbody></tgroup></table></table-wrap>
<supplementary-material xlink:href="s.csv"/></body><back><ref-list><ref id="b1"><citation citation-type="journal">R</citation></ref></ref-list></back></article></pmc-articleset>"""


def test_house():
    root, missing = to_house(parse(JATS), "MORE-1", [("42", "Health")], ["a.jpg"])
    out = serialise(root)
    assert missing == ["s.csv"] and parse(out).name == "article"
    assert [k.name for k in root.first("article-meta").nodes()] == ["article-id", "article-categories", "title-group", "contrib-group", "contrib-group", "aff", "aff", "permissions"]
    assert [k.name for k in root.first("journal-meta").nodes()] == ["journal-title-group", "issn"]
    assert 'license-type="creative-commons"' in out and "<license-p>" in out and 'publication-type="journal"' in out and "<citation" not in out
    assert "https://doi.org/10.1234/ab" in out and "and words tail" in out and "self-uri" not in out
    assert out.count("<graphic") == 1 and "assets/a.jpg" in out and '<th colspan="2">H</th>' in out and '<td align="left">2</td>' in out
    assert [a.attrs["id"] for a in root.walk("aff")] == ["aff2", "aff1"]
    assert residual(root) == 2
    body_latex(root)
    m = measure(root)
    assert m == {"root_is_article": True, "has_title": True, "contrib_count": 1, "affs_all_have_ids": True, "residual_latex": 0, "bibr_links": 1, "ref_count": 1, "fig_count": 1, "formula_count": 2, "cc_license_typed": True}
    assert '[<xref ref-type="bibr" rid="b1">1</xref>, 7]' in serialise(root) and "$x$" not in prose(root)


TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title type="main">Title</title></titleStmt><sourceDesc><biblStruct><analytic><author><persName><forename>A</forename><surname>B</surname></persName><affiliation>U</affiliation></author></analytic></biblStruct></sourceDesc></fileDesc>
<profileDesc><abstract><p>Abs</p></abstract></profileDesc></teiHeader><text><body><div><head>1.2. Intro</head><p><s>See <ref type="bibr">[2,</ref> <ref type="bibr">(Smith et al., 2020;</ref> <ref type="figure">Fig. 1</ref>  and <ref type="bibr">Doe 1999</ref>.</s></p><p> </p></div>
<figure xml:id="fg"><head>Figure 1</head><figDesc>Cap</figDesc></figure></body><back><div type="funding"><div><p>Money</p></div></div><div type="acknowledgement"><p>Ta</p></div><div type="annex"><div><head>Appendix A</head><p>x</p></div><div><head>.1</head><p>y</p></div></div>
<listBibl><biblStruct xml:id="b0">Smith 2020</biblStruct><biblStruct xml:id="b1">Roe 2001</biblStruct></listBibl></back></text></TEI>"""


def test_tei():
    out = serialise(from_tei(parse(TEI), {"journal": "J"}, "numbered", True))
    assert "<label>1.2</label><title>Intro</title>" in out
    assert '[<xref ref-type="bibr" rid="b1">2</xref>, (<xref ref-type="bibr" rid="b0">Smith et al., 2020</xref>;' in out
    assert '<xref ref-type="fig" rid="fg">' in out and "and Doe 1999." in out and "<p> </p>" not in out
    assert "<funding-statement>Money</funding-statement>" in out and out.count("<app ") == 1 and "<bold>.1</bold>" in out and "<ack>" in out


def test_publisher_vocabulary():
    xml = """<article xmlns:ce="u"><head><ce:title>T</ce:title><ce:author-group><ce:author orcid="1"><ce:given-name>A</ce:given-name><ce:surname>B</ce:surname></ce:author></ce:author-group><ce:author-group><ce:author orcid="1"><ce:given-name>A</ce:given-name><ce:surname>B</ce:surname></ce:author><ce:collaboration>C</ce:collaboration></ce:author-group></head>
    <body><ce:sections><ce:section id="s"><ce:section-title>S</ce:section-title><ce:para>a <ce:hsp/>b<ce:footnote id="fn9"><ce:label>a</ce:label><ce:note-para>n</ce:note-para></ce:footnote> <ce:cross-ref refid="bib1">[1]</ce:cross-ref> <ce:inf>i</ce:inf></ce:para><ce:odd>kept</ce:odd></ce:section></ce:sections></body>
    <tail><ce:bib-reference id="bib1"><ce:label>[1]</ce:label><x>Q</x><ce:doi>10.1/z</ce:doi></ce:bib-reference></tail></article>"""
    out = serialise(from_publisher(parse(xml)))
    assert out.count("<contrib ") == 2 and "<collab>C</collab>" in out and '<xref ref-type="fn" rid="fn9">a</xref>' in out and '<fn id="fn9"><label>a</label><p>n</p></fn>' in out
    assert '<xref ref-type="bibr" rid="bib1">[1]</xref> <sub>i</sub>' in out and "<p>kept</p>" in out and '<pub-id pub-id-type="doi">10.1/z</pub-id>' in out and "<label>1</label>" in out


def test_damaged_documents():
    assert serialise(parse("<a x='1'><b>t</c> &lt; &eacute; 1 < 2<d/></b><e>open", recover=True)) == '<a x="1"><b>t &lt; é 1 &lt; 2<d/></b><e>open</e></a>'
    assert serialise(parse("<?xml version='1.0'?><!DOCTYPE a [<!ENTITY x 'y'>]><ns:a><!-- no --><![CDATA[1 < 2]]><b></a>after", recover=True)) == "<a>1 &lt; 2<b/></a>"
    assert serialise(parse("<a><b>whole</b></a>", recover=True)) == "<a><b>whole</b></a>"
    for text in ("", "no element", "<"):
        with pytest.raises(ValueError, match="not well formed"):
            parse(text, recover=True)
    with pytest.raises(ValueError, match="not well formed"):
        parse("<a><b></a>")
    whole = serialise(to_house(parse(JATS), "M", [], ["a.jpg"])[0])
    for cut in range(len(JATS) // 2, len(JATS), 37):  # a download that broke off
        parse(JATS[:cut], recover=True)
    assert serialise(to_house(parse(JATS + "<trailing", recover=True), "M", [], ["a.jpg"])[0]) == whole


def test_front_matter_and_journal():
    root = parse(r"<article><front><article-title>A $\alpha$ b<sub>\beta</sub> \pm c <inline-formula><tex-math>$\gamma$</tex-math></inline-formula></article-title></front><body><p>$x$</p></body></article>")
    front_latex(root)
    assert serialise(root) == r"<article><front><article-title>A α b<sub>β</sub> ± c <inline-formula><tex-math>$\gamma$</tex-math></inline-formula></article-title></front><body><p>$x$</p></body></article>".replace("<tex-math>", "<tex-math>")
    assert source_journal(parse("<d xmlns:p='u'><p:srctitle>Second</p:srctitle><p:publicationName> First  J </p:publicationName></d>")) == "First J"
    assert source_journal(parse("<d><srctitle>S</srctitle></d>")) == "S" and source_journal(parse("<d/>")) is None


def test_repair():
    root = parse("<article><fig/><fig><graphic href='assets/x.png'/></fig><fig id='k'><label>L</label></fig></article>")
    assert len(orphan_figures(root)) == 2
    assert wire(root, [("b.png", "B $\\alpha$", 2), ("a.png", "A", 1), ("c.png", "C", 3)]) == (2, True)
    out = serialise(root)
    assert '<fig id="fig1"><label>Figure 1</label><caption><p>A</p></caption><graphic xlink:href="assets/a.png"/></fig>' in out and "<label>L</label><caption><p>B α</p></caption>" in out


def test_rows_never_fail_the_job(spark):
    df = spark.createDataFrame([("1", "<<no element", "jats"), ("2", JATS, "jats"), ("3", None, "tei")], "id string, xml string, kind string").selectExpr("*", "'M' as mid", "null as meta", "cast(null as array<struct<code:string,label:string>>) as codes", "array('a.jpg') as assets")
    got = {r.id: r for r in documents.crosswalk(df).collect()}
    assert got["1"].article is None and "not well formed" in got["1"].error and got["3"].error and got["2"].error is None and got["2"].residual == 0
    prints = documents.fingerprint(documents.crosswalk(df).where("id = '2'")).first()
    assert prints.fig_count == 1 and prints.cc_license_typed
    assert documents.texts(df.where("id = '2'").select("id", "xml"), "xml").first().refs == 1
    links = df.where("id = '2'").select(documents.image_links("xml").alias("i"), documents.extra_links("xml").alias("x"), documents.figure_stubs("xml").alias("s")).first()
    assert links.i == ["a.gif", "a.jpg", "m.png"] and links.x == ["s.csv"] and links.s == ["a.gif", "x/a.jpg", "m.png"]


@pytest.mark.parametrize("raw, want", [
    (r"$\sqrt{s}$ = 13 \TeV", "√s = 13 TeV"), (r"$p_{T}^{2}$", "pT²"), (r"\alpha\leq\le", "α≤≤"), (r"a -- b --- c", "a – b — c"), (r"x^{-1}_{0}", "x⁻¹₀"), (r"m_{\mathrm{lep}}", "mₗₑₚ"), (r"\bar{t}t", "t̄t"),
    (r"\frac{a}{b} \SI{13}{TeV}", "a/b 13 TeV"), (r"5\% \& ( a )", "5% & (a)"), (r"see \cite{x} .", "see."), (r"\foo{bar}", "bar"), ("plain", "plain"), ("", ""), (None, None), (r"\mX^\pm", "mX±"), (r"\left( x \right)", "(x)"), ("q^{q}", "qq"),
    (r"H\to\gamma\gamma, \MET", "H→γγ, ETᵐⁱˢˢ"), (r"a\, b\quad c~d", "a b c d"), (r"\sqrt 2 \hat x\=o \={u}", "√2 x\u0304o\u0304 u\u0304"), (r"\overline{ab} \num{5}", "a\u0304b 5"), (r"\textrm{\mathbf{x}} {y}", "x y"),
    (r"\looseness=-1 text \label{q}end", " text end"), ("a ^ b _", "a ^ b _"), (r"\SI{1} \frac", "1 "), (r"x_i^2", "xᵢ²"), (r"\ref", ""), (r"a\\b", "a\\"), ("{", "{"), ("${", ""), ("-----", "—–"),
])
def test_latex(raw, want):
    assert clean(raw) == want


def test_latex_spans():
    text = r"a \$5 $x$ $$y$$ \[z\] \(w\) \begin{align*}p&q\end{align*} \cite{k, l} \citep {m} $open \begin{other}x\end{other} $$"
    got = [(kind, content) for _, _, kind, content in latex_spans(text)]
    assert got[:7] == [("inline", "x"), ("block", "y"), ("block", "z"), ("inline", "w"), ("block", "p&q"), ("cite", "k, l"), ("cite", "m")] and list(latex_spans(r"\$a\$ \begin{equation")) == []
    assert [text[a:b] for a, b, _, _ in latex_spans(text)][:2] == ["$x$", "$$y$$"]


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert one(T.slug(F.lit("--Taylor & Francis!"))) == "taylor-francis" and one(T.slug(F.lit(None).cast("string"), "unknown")) == "unknown"
    assert one(T.doi_variants(F.lit("10.1103/physrevx.1.2"))) == ["10.1103/physrevx.1.2", "10.1103/PhysRevX.1.2"] and one(T.doi_variants(F.lit("10.1103/physrevx.1.2"), True)) == ["10.1103/physrevx.1.2"]
    assert one(T.split_list(F.lit('a,"b,c",d,'))) == ["a", "b,c", "d"] and one(T.citation_number(F.lit("bibitem003"))) == "3" and one(T.citation_number(F.lit("abc"))) == "abc"
    assert one(T.title(F.lit("<article-title x='1'> A <i>b</i> </article-title>"))) == "A b" and one(T.title(F.lit("x"))) is None
    assert tuple(one(T.person(F.lit("Ana  Maria Silva")))) == ("Ana Maria", "Silva") and tuple(one(T.person(F.lit("Plato")))) == ("", "Plato")
    assert [tuple(x) for x in one(T.plan_items(F.lit("A: B:2,C:3")))] == [("A: B", 2), ("C", 3)]
    assert one(T.captions_aligned(F.lit("The quick brown fox"), F.lit("xx quick-brown yy"))) and not one(T.captions_aligned(F.lit("short"), F.lit("short")))
    assert one(T.xml_escaped(F.lit("<a&\">"))) == "&lt;a&amp;&quot;&gt;" and one(T.hash16(F.lit(None).cast("string"))) == "missing"
    assert one(T.tokens(T.normal_form(F.lit("Eﬃcient hy-\n phen café ①2")))) == ["efficient", "hyphen", "caf", "12"]
    assert one(T.shingles(F.array(*[F.lit(x) for x in "abcdef"]))) == ["a b c d e", "b c d e f"] and one(T.shingles(F.array(F.lit("a")))) == []
    v = one(T.licence_verdict(F.lit("<permissions>Creative Commons Attribution NonCommercial</permissions>")))
    assert (v.ok, v.detail) == (False, "restrictive Creative Commons terms (not CC-BY)")
    for h, want in [("a/b.png", True), ("#x", False), ("", False), ("doi:1", False), ("HTTP://x", False), ("a/b:c", True), (" www.x", False)]:
        assert one(T.local_href(F.lit(h))) == want


def body(n):
    return " ".join(f"word{i} alpha{i * 7 % 1000}x" for i in range(n))


def test_fidelity_mutants(spark):
    whole = body(2000)
    rows = [("intact", whole, whole, 5, 5, None), ("cut", whole, body(600), 5, 5, None), ("refs", whole, whole, 4, 5, None), ("unknown", whole, whole, 4, None, 0.0), ("short", "a b c", "a b c", 0, None, None),
            ("empty", whole, "", 0, None, None), ("floor", whole, body(1700), 0, None, 0.9), ("other", whole, " ".join(f"zz{i}q" for i in range(4000)), 0, None, None)]
    got = {r.pair_id: r for r in fidelity.evaluate(spark.createDataFrame(rows, "pair_id string, source_text string, target_text string, ref_target int, ref_source int, floor double")).collect()}
    assert got["intact"].verdict == got["unknown"].verdict == "pass" and got["intact"].completeness == 1.0
    assert got["cut"].verdict == "fail" and got["refs"].verdict == "fail" and "parity" in got["refs"].reasons[0]
    assert got["short"].completeness == 0.0 and got["short"].num_recall == 1.0 and got["empty"].grounding == 0.0
    assert got["floor"].verdict == "flag" and len(got["floor"].reasons) == 1 and any("wrong pairing" in x for x in got["other"].reasons)
    runs = fidelity.missing_runs(spark.createDataFrame(rows[1:2], "pair_id string, source_text string, target_text string, ref_target int, ref_source int, floor double")).collect()
    assert len(runs) == 1 and runs[0].at_token == 1196 and runs[0].shingles == 2800 and len(runs[0].snippet) <= 160


def test_archives(spark):
    z, t = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        for n in ("d/a.jpg", "d/a.png", "d/logo.png", "d/b.eps"):
            f.writestr(n, n)
    with tarfile.open(fileobj=t, mode="w") as f:
        info = tarfile.TarInfo("x/y.txt")
        info.size = 2
        f.addfile(info, io.BytesIO(b"hi"))
    df = spark.createDataFrame([("z", z.getvalue()), ("t", gzip.compress(t.getvalue())), ("bad", b"junk"), ("none", None)], "path string, content binary")
    got = read_members(df)
    assert {(r.path, r.member) for r in got.collect()} == {("z", "a.jpg"), ("z", "a.png"), ("z", "logo.png"), ("z", "b.eps"), ("t", "y.txt"), ("bad", None), ("none", None)}
    assert {(r.stem, r.member) for r in pick_figures(got).collect()} == {("a", "a.png"), ("b", "b.eps")}
    assert [r[0] for r in df.orderBy("path").select(kind("content")).collect()] == ["other", "other", "gzip", "zip"] and unzipped(gzip.compress(b"q")) == b"q"
    x = spark.createDataFrame([("<article><front>", "<!DOCTYPE a '//ES//DTD'>"), ("<html>", "tei-c.org/ns/1.0"), (None, "z")], "a string, b string").select(is_jats("a"), transform_for("b")).collect()
    assert [tuple(r) for r in x] == [(True, "elsevier"), (False, "tei"), (False, "jats")]


def test_measures_are_those_of_the_tree(spark):
    bodies = [r"a $x$ b \$5 and $y", r"$$y$$ \[z\] \(w\) \begin{align*}p&amp;q\end{align*}", r"\cite{k, l} \citep {m} $open \begin{other}x\end{other} $$", "plain", r"<p>in $a$</p><inline-formula><tex-math>$no$</tex-math></inline-formula>tail $b$ $c$", r"$\alpha\$ $ \\ $q$", ""]
    rows = [(str(i), f'<article><front><article-meta><title-group><article-title>{"T" if i % 2 else " "}</article-title></title-group><contrib-group><contrib contrib-type="author"/><contrib/></contrib-group><aff{" id=" + chr(34) + "a" + chr(34) if i % 3 else ""}>x</aff></article-meta></front><body><p>{b}</p><fig/><fig/></body><back><ref-list><ref/><xref ref-type="bibr"/></ref-list></back></article>') for i, b in enumerate(bodies)]
    rows += [("none", "<article/>"), ("other", "<x><license license-type='creative-commons'/></x>"), ("typed", documents.DOCTYPE + "<article xmlns:xlink='http://www.w3.org/1999/xlink'><aff id='q'/><license license-type='creative-commons' xlink:href='h'/></article>")]
    df = spark.createDataFrame(rows, "id string, article string")
    names = [x.split()[0] for x in documents.FINGERPRINT.split(", ")]
    one, two = ({r.id: tuple(r[n] for n in names) for r in f(df).collect()} for f in (documents.measures, documents.fingerprint))
    assert one == two and one["1"][4] == 4
    plan = documents.measures(df)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_caption_keys_are_made_once(spark):
    """Not for every place of the key, inside of the lambda."""
    df = spark.createDataFrame([("The quick brown fox", "xx quick-brown yy"), ("short", "short"), (None, "a"), ("quick brown", None)], "a string, b string")
    got = df.select(T.captions_aligned("a", "b").alias("v"))
    assert [r.v for r in got.collect()] == [True, False, False, None]
    inside = got._jdf.queryExecution().optimizedPlan().toString().split("lambdafunction(")[1:]
    assert len(inside) == 2 and not any("regexp_replace" in x for x in inside)


def test_workers_hold_a_part_of_a_batch(monkeypatch):
    """Rows of objects are made of a megabyte or so, however large a batch is, and every row comes, whatever its size."""
    rows = [(str(i), "x" * size) for i, size in enumerate([300_000] * 20 + [3_000_000, 1, 0, 5])]
    batch = pa.RecordBatch.from_pylist([{"id": i, "xml": x} for i, x in rows] + [{"id": "null", "xml": None}])
    run = documents._per_document([("n", pa.int32())], lambda xml: (len(xml),))
    parts = [p.to_pylist() for p in run([batch, batch.slice(0, 0)])]
    assert [(r["id"], r["n"]) for p in parts for r in p] == [(i, len(x)) for i, x in rows] + [("null", None)] and parts[-1][-1]["error"]
    assert max(sum(r["n"] or 0 for r in p) for p in parts if len(p) > 1) <= documents.SLICE_BYTES and len(parts) > 6


def test_work_grows_with_nodes_and_not_with_letters():
    """Calls made for a paragraph: its letters aren't looked at one by one, and a dozen passes or so visit it."""
    def calls(paragraphs, letters):
        n, xml = [0], "<article><front><article-meta/></front><body>" + ("<p>" + "a" * letters + "</p>") * paragraphs + "<p>$x$</p></body></article>"

        def count(frame, event, arg):
            n[0] += event in ("call", "c_call")
        sys.setprofile(count)
        try:
            out = documents._housed(xml, "jats", "M", "{}", [], ["a.jpg"])
            measured = measure(parse(out[0]))
        finally:
            sys.setprofile(None)
        assert out[0].count("<p>" + "a" * letters + "</p>") == paragraphs and measured["residual_latex"] == 0
        return n[0]
    base = calls(100, 10)
    assert calls(100, 2000) < base * 1.2 and calls(300, 10) - base < 200 * 130
