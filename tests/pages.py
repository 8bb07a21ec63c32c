"""Hand-written detail pages in the three layouts (invented text), with the
hazards the extractors must survive: padded text, nested p, decoy ids,
unclosed meta tags, content-before-name, mixed quotes and case, entities,
script and comment decoys."""

LAYOUT_A = """<!DOCTYPE html>
<html><head>
<meta charset="utf-8">
<script>var s = "<meta name='citation_title' content='script decoy'>"; var t = "</div>";</script>
<!-- <meta name="citation_title" content="comment decoy"> -->
<meta name="citation_title" content="Sparse Sketches &amp; Streaming &quot;Heavy&quot; Hitters">
  <meta content='Ada Quill' name='citation_author'>
    <meta NAME="citation_author" CONTENT="Bo Rivet">
<meta content="2021/07/18" name="citation_publication_date">
<meta name=citation_pdf_url content=https://site.example/v1/quill21a.pdf>
<style>.abstract{color:red}</style>
</head><body><div id="main">
<div class="abstract">
      We study sketches for <b>heavy hitters</b> &lt;under&gt; streams.
      Second line of the abstract.
   </div>
<code class="citecode" id="endnote">%0 Conference Paper %T decoy</code>
<code class="citecode" id="bibtex">
@InProceedings{quill21a,
	title = {Sparse Sketches},
	author = {Quill, Ada and Rivet, Bo}
}
</code>
<code class="citecode" id="apa">Quill, A. (2021). decoy</code>
</div></body></html>
"""

LAYOUT_A_EXPECTED = dict(
    title='Sparse Sketches & Streaming "Heavy" Hitters',
    authors=["Ada Quill", "Bo Rivet"],
    year=2021,
    url_pdf="https://site.example/v1/quill21a.pdf",
    abstract="We study sketches for heavy hitters <under> streams.\n      Second line of the abstract.",
    bibtex="@InProceedings{quill21a,\n\ttitle = {Sparse Sketches},\n\tauthor = {Quill, Ada and Rivet, Bo}\n}",
)

LAYOUT_B = """<html><head>
<meta name="citation_title" content="Quiet Gradients">
<meta name="citation_author" content="Mott, Ilse">
<meta name="citation_author" content="Park, Juno">
<meta name="citation_pdf_url" content="https://conf.example/paper/qg.pdf">
<meta name="citation_publication_date" content="2019-12-08">
</head><body>
<div class="container-fluid">
<h4>
  Quiet Gradients
</h4>
<h4>Authors</h4>
<p><i>Ilse Mott, Juno Park</i></p>
<div>
<a class="btn" href="/paper/qg-Paper.pdf">Paper</a>
<a class="btn" href="/paper/qg-Bibtex.bib">
     Bibtex
   </a>
<a class="btn" href="/paper/qg-Supplemental.zip">Supplemental</a>
</div>
<h4>
     Abstract
    </h4>
<p>
<p>Gradients that whisper: a study of &amp; in optimisation.</p>
</p>
</div></body></html>
"""

LAYOUT_B_EXPECTED = dict(title="Quiet Gradients", authors=["Mott, Ilse", "Park, Juno"], year=2019,
                         abstract="Gradients that whisper: a study of & in optimisation.",
                         bibtex_href="/paper/qg-Bibtex.bib")

LAYOUT_C = """<html><head><title>[2101.00042] Tiny Transformers</title></head><body>
<h1 class="title">not this one</h1>
<h1 class="title mathjax"><span class="descriptor">Title:</span>Tiny Transformers</h1>
<div class="authors"><span class="descriptor">Authors:</span>
<a href="/a/lee_k_1">Kai Lee</a>,
<a href="/a/oduya_n_1">Nia Oduya</a></div>
<blockquote class="abstract mathjax">
            <span class="descriptor">Abstract:</span> Small models,
large claims.
    </blockquote>
<div class="full-text"><ul><li><a href="/pdf/2101.00042" accesskey="f" class="abs-button">PDF</a></li></ul></div>
</body></html>
"""

LAYOUT_C_EXPECTED = dict(title="Tiny Transformers", authors="Kai Lee, Nia Oduya",
                         abstract="Small models, large claims.", pdf="/pdf/2101.00042")
