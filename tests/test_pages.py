"""Parsing of stored pages."""

from pyspark.sql import functions as F

from homematch.sources import pages

DETAILS = "font-heading text-xs flex flex-wrap border-t border-b mb-6 md:text-md py-3 md:py-4 md:mb-9"
FULL = f"""<html><body><h1 class="h4 md:text-xl leading-normal"> 2 bed flat &amp; garden </h1>
<div class="text-slate h4 font-normal leading-none font-heading">1 Road<br>Town</div>
<div class="otm-Price"><span class="price">£105,000</span><small class="qualifier">Guide price</small></div>
<div class="text-denim"><small class="font-heading">Added today</small></div>
<div class="otm-PropertyIcon"><script>x()</script>Apartment</div>
<div class="{DETAILS}"><div>2 bed</div><div>1 bath</div><div>EPC rating: C</div><div>312 sq ft / 29 sq m</div></div>
<section class="otm-FeaturesList"><ul><li class="otm-ListItemOtmBullet">Tenure: Leasehold</li><li class="x">no</li>
<li class="otm-ListItemOtmBullet"><b>Parking</b></li></ul></section></body></html>"""


def test_listing_record(spark):
    df = spark.createDataFrame([(1, "u1", FULL), (2, "u2", "<p>bare"), (3, "u3", None)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in pages.listing_records(df).collect()}
    one = rows[1].asDict()
    assert one["title"] == "2 bed flat & garden" and one["address"] == "1 RoadTown" and one["price"] == "£105,000"
    assert one["pricing_qualifier"] == "Guide price" and one["listing_time"] == "Added today" and one["property_type"] == "Apartment"
    assert (one["bedrooms"], one["bathrooms"], one["epc_rating"], one["size"]) == ("2 bed", "1 bath", "EPC rating: C", "312 sq ft / 29 sq m")
    assert one["features"] == ["Tenure: Leasehold", "Parking"] and one["error"] is None
    assert rows[2].price == "Price not available" and rows[2].size == "Size info not available" and rows[2].features == []
    assert rows[3].error == "empty page" and rows[3].title is None


def test_links(spark):
    html = '<a href="/details/1/">a</a> <A class="x" href="/details/2/">b</A> <a href="/other">c</a> <a href="/details/1/">d</a><a title="Next page" href="/p?page=2">n</a>'
    df = spark.createDataFrame([(1, html), (2, "<p></p>")], "page_id long, html string")
    assert sorted(r[0] for r in pages.listing_links(df, "https://h.example").collect()) == ["https://h.example/details/1/", "https://h.example/details/2/"]
    assert [r[0] for r in df.orderBy("page_id").select(pages.next_page(F.col("html"), "https://h.example")).collect()] == ["https://h.example/p?page=2", None]
    odd = "<a class=x href='/details/3/?a=1&amp;b=2'>a</a><a href=/details/4/>b</a><a>c</a><a href='/p?page=3&amp;s=1' title='Next page'>n</a>"
    odd += '<section id="s" class="wide otm-FeaturesList"><li class="first otm-ListItemOtmBullet">Gas &amp; water</li></section>'
    df = spark.createDataFrame([(1, odd), (2, None), (3, "")], "page_id long, html string")
    assert sorted(r[0] for r in pages.listing_links(df, "https://h.example").collect()) == ["https://h.example/details/3/?a=1&b=2", "https://h.example/details/4/"]
    assert [r[0] for r in df.orderBy("page_id").select(pages.next_page(F.col("html"), "https://h.example")).collect()] == ["https://h.example/p?page=3&s=1", None, None]
    assert [r[0] for r in df.orderBy("page_id").select(pages.feature_bullets(F.col("html"))).collect()] == [["Gas & water"], None, []]
    bullets = spark.createDataFrame([(FULL,)], "html string").select(pages.feature_bullets(F.col("html"))).first()[0]
    assert bullets == ["Tenure: Leasehold", "Parking"]
