"""Literal fixtures for the Arabic pack, expected rows derived by hand from the rules."""

from pyspark.sql import functions as F

from rootloom.functions import normalize, normalize_root
from rootloom.operators import (audit, body, chapters, claimgraph, claims, enrich, governed, identity, origins,
                                predicates, quarantine, registry, segment)
from rootloom.rules import arabic as A, vocab as V
from rootloom.sources.schemas import LINE, ROOT_ENTRY

AUTO = dict(entry_id="02.pdf:p100:r001", source_pdf="02.pdf", pdf_page=100,
            root_heading_text="( حلك ) الحاء واللام والكاف", root_letters="حلك", bab_letter="الحاء",
            corrected_bab_letter="الحاء", original_bab_letter="الحاء", semantic_origin_type="SINGULAR",
            origin_count=1, review_status="AUTO_AGREED", semantic_origin_text="يدل\u064f\u0651 على السواد")
REVIEW = dict(AUTO, entry_id="02.pdf:p101:r001", root_letters="حمش", semantic_origin_type="DUAL", origin_count=2,
              review_status="REVIEW_REQUIRED", semantic_origin_text=None)
WRONG = dict(AUTO, entry_id="02.pdf:p102:r001", root_letters="حمز", bab_letter="الضاد", original_bab_letter="الضاد")
GAP_INITIALS = (*A.MISSING_INITIALS,)


def entries(spark, *rows):
    names = [f.name for f in ROOT_ENTRY.fields]
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("line_no", LongType()), *ROOT_ENTRY.fields])
    return spark.createDataFrame([(i, *(r.get(n) for n in names)) for i, r in enumerate(rows)], schema)


def asks(spark, *roots):
    return spark.createDataFrame([(i, r) for i, r in enumerate(roots)], "request_id long, root string")


def enriched(spark, *texts, pack=A.ORIGINS_V2):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "entry_num long, body_text string")
    return enrich.enrich(df, pack).orderBy("entry_num").collect()


def test_normalise_profiles(spark):
    df = spark.createDataFrame([("أَصْلٌ  وَاحِدَةٌ ى",)], "t string")
    row = df.select(normalize(F.col("t"), A.PROFILES["lookup"]).alias("a"),
                    normalize_root(F.lit("ق و م"), A.PROFILES["lookup"]).alias("b"),
                    normalize(F.lit("الرَّجل"), A.PROFILES["entity"]).alias("c"),
                    normalize(F.lit("ءمن"), A.PROFILES["hamza"]).alias("d")).first()
    assert tuple(row) == ("اصل واحده ي", "قوم", "رجل", "امن")
    again = df.select(normalize(normalize(F.col("t"), A.PROFILES["lookup"]), A.PROFILES["lookup"]).alias("a")).first()
    assert again.a == row.a


def test_cascade_v2(spark):
    rows = enriched(
        spark,
        "الحاء والجيم والراء أصلان، أحدهما المنع، والآخر الإحاطة.",
        "الحاء واللام والكاف أصل واحد، وهو السواد.",
        "الحاء والميم والشين يدل على الدقة.",
        "الحاء والميم والزاء كلمة واحدة.",
        "الحاء والصاد ليس بأصل ولا فرع.",
        "الحاء والدال فيه نظر.",
        "الخاء والباء معظم بابه الستر والتغطية.",
        "الخاء والتاء ثلاثة أصول: الأول القطع، والثاني الجمع.",
        "كلام بلا دلالة")
    assert [r.entry_type for r in rows] == [
        "MULTI_ORIGIN", "SINGLE_ORIGIN", "SINGLE_ORIGIN", "SINGLE_WORD", "NO_ROOT_OR_UNCERTAIN", "UNCERTAIN",
        "SINGLE_ORIGIN", "MULTI_ORIGIN", "UNKNOWN"]
    assert [r.axes_count for r in rows] == [2, 1, 1, 1, 0, None, 1, 3, None]
    assert [a.text for a in rows[0].semantic_axes] == ["المنع", "الاحاطة"]
    assert [a.text for a in rows[1].semantic_axes] == ["السواد"]
    assert [a.text for a in rows[6].semantic_axes] == ["الستر والتغطية"]


def test_cascade_v1_bare_word_comes_first(spark):
    rows = enriched(spark, "الحاء والميم كلمة واحدة، وهي القطع.", pack=A.ORIGINS_V1)
    assert rows[0].entry_type == "SINGLE_WORD"
    assert [a.text for a in rows[0].semantic_axes] == ["القطع"]


def test_authorities_and_quality(spark):
    row = enriched(spark, "قال الخليل وأبو عمرو وابن دريد وقال الخليل ~~~")[0]
    assert row.quoted_authorities == sorted(["الخليل", "أبو عمرو", "ابن دريد"])
    assert 0 <= row.ocr_confidence < 1


def test_segmentation_is_block_invariant(spark):
    pages = [(1, 1, "كتاب الخاء\n[خبز]\nالخاء والباء والزاء أصل واحد\nسطر آخر (ص٤٥)"),
             (1, 2, "[خبل]\n"), (1, 3, "الخاء والباء واللام أصل\n(١) حاشية\nشطر أول طويل … شطر ثان طويل"),
             (1, 4, "[عنوان]\nسطر عادي\nوأما الهمزة والصاد فله معنيان"), (2, 1, "قبل أي مدخل")]
    df = spark.createDataFrame(pages, "book long, page_num long, text string")
    results = []
    for block in (1, 2, 1000):
        rows = segment.segment_entries(df, A.LINES, pages_per_block=block).orderBy("book", "entry_num").collect()
        results.append([tuple(r) for r in rows])
    assert results[0] == results[1] == results[2]
    rows = segment.segment_entries(df, A.LINES).orderBy("book", "entry_num").collect()
    assert [(r.root_letters, r.root_display) for r in rows] == [("خب", "خبز"), ("خب", "خبل"), ("أص", "أص")]
    assert rows[0].page_refs == ["٤٥"] and rows[0].chapter_header == "كتاب الخاء"
    assert rows[1].footnote_lines == ["(١) حاشية"] and len(rows[1].poetry_lines) == 1
    assert rows[1].raw_page_nums == [3, 4]
    lines = segment.numbered_entry_lines(segment.entry_lines(df, A.LINES, pages_per_block=1)).where("filled AND role <> 'footnote'")
    assert lines.agg(F.sum(F.length("line") + 1)).first()[0] == sum(len(r.body_text) for r in rows)


def test_registry_lookup_kinds(spark):
    reg = registry.merge_roots(entries(spark, AUTO, REVIEW, WRONG), A.CHAPTER_NAMES, GAP_INITIALS)
    ask = asks(spark, "حلك", "حمش", "حمز", "بسط", "أمر", "ححح", "")
    out = registry.catalog_evidence_ids(registry.typed_lookup(ask, reg, (*GAP_INITIALS, "أ", "إ", "آ")))
    rows = {r.root: r for r in out.collect()}
    assert rows["حلك"].kind == "FOUND_AUTO_AGREED"
    assert rows["حلك"].evidence_ids == ["lex:root:حلك:origin:SINGULAR:count:1", "lex:root:حلك:bab:الحاء"]
    assert rows["حمش"].kind == "FOUND_REVIEW_REQUIRED" and rows["حمش"].evidence_ids == ["lex:root:حمش:bab:الحاء"]
    assert rows["حمز"].bab_letter == "الحاء" and rows["حمز"].original_bab_letter == "الضاد"
    assert rows["بسط"].kind == rows["أمر"].kind == "MISSING_VOLUME_COVERAGE_GAP"
    assert rows["ححح"].kind == "NOT_FOUND_IN_COVERED_VOLUME" and rows[""].kind == "INVALID_ROOT_INPUT"


def test_merge_prefers_agreed_page(spark):
    first = dict(REVIEW, root_letters="حلك", semantic_origin_type="TRIPLE", source_pdf="03.pdf")
    row = registry.merge_roots(entries(spark, first, AUTO, dict(AUTO, source_pdf="03.pdf")), A.CHAPTER_NAMES).first()
    assert (row.semantic_origin_type, row.origin_count, row.entry_count) == ("SINGULAR", 1, 3)
    assert row.source_pdfs == ["03.pdf", "02.pdf"] and row.review_status == "AUTO_AGREED"


def test_chapter_correction(spark):
    out = chapters.correct_chapter(entries(spark, WRONG, dict(AUTO, root_letters="")), A.CHAPTER_NAMES)
    assert [r.corrected_bab_letter for r in out.orderBy("line_no").collect()] == ["الحاء", ""]
    assert chapters.correction_report(out).first().bab_changed == 1


def test_gates(spark):
    roots = {"أمر": "G09", "حدرج": "G12", "حد": "G13", "صضر": "G05", "حَد": "G20", "حخر": "G01"}
    df = spark.createDataFrame([(r,) for r in roots], "root string")
    out = df.select("root", identity.ocr_gates(F.col("root")).alias("g"),
                    identity.ocr_gates(F.col("root"), strict_compat=True).alias("s")).collect()
    for r in out:
        flags = {x.gate: x.flag for x in r.g}
        assert len(flags) == 20 and flags[roots[r.root]] and not flags["G11"]
        assert not {x.gate: x.flag for x in r.s}["G01"]


def test_conflicts_and_governed_lookup(spark):
    other = dict(AUTO, entry_id="02.pdf:p300:r001", semantic_origin_type="DUAL")
    noise = dict(AUTO, root_letters="حرف", semantic_origin_type="CHAPTER_HEADER")
    imports = quarantine.import_entries(entries(spark, AUTO, other, REVIEW, noise, dict(AUTO, root_letters="حمز")))
    assert [r.root_letters for r in claims.detect_conflicts(imports).collect()] == ["حلك"]
    ask = asks(spark, "حلك", "حمش", "حمز", "ءمن", "حرف", "")
    out = {r.root: r for r in governed.governed_lookup(
        ask, imports, (*GAP_INITIALS,), A.PROFILES["hamza"]).collect()}
    assert out["حلك"].kind == "FOUND_CONFLICT_REVIEW_REQUIRED"
    assert out["حمش"].kind == "FOUND_REVIEW_REQUIRED_UNRESOLVED"
    assert out["حمز"].kind == "FOUND_MACHINE_CANDIDATE_ONLY"
    assert out["ءمن"].kind == "MISSING_VOLUME_COVERAGE_GAP" and out["ءمن"].coverage_note
    assert out["حرف"].found and out["حرف"].noise_only and out[""].kind == "NOT_FOUND_IN_COVERED_VOLUME"
    cl = claims.root_claims_build(imports)
    lookups = governed.governed_lookup(ask, imports, GAP_INITIALS, A.PROFILES["hamza"])
    ids = governed.governed_evidence_ids(lookups, cl, claims.origin_candidates(cl))
    mine = [r.evidence_id for r in ids.where("request_id = 2").orderBy("step", "position").collect()]
    assert mine[0] == "lex:root:حمز:bab:الحاء" and mine[1] == "lex:root:حمز:origin:SINGULAR:count:1" and len(mine) == 5


def test_policies(spark):
    multi = dict(AUTO, semantic_origin_type="MULTIPLE")
    bare = dict(AUTO, semantic_origin_text=None)
    cl = claims.root_claims_build(quarantine.import_entries(entries(spark, AUTO, multi, bare)))
    assert claims.origin_candidates(cl).count() == 1
    assert claims.origin_candidates(cl, "heading_fallback").count() == 3
    kinds = [r.residual_type for r in claims.segmentation_deferral_residuals(cl).collect()]
    assert sorted(kinds) == ["ORIGIN_NOT_EXTRACTED", "SEGMENTATION_REQUIRED"]


def test_licences(spark):
    rows = [(0, "ACCEPT", "حلك"), (1, "DEFER", "حلك"), (2, "BLOCK", "حلك"), (3, "ACCEPT", None), (4, "ACCEPT", ""),
            (5, None, "حلك"), (6, "X", "حلك")]
    df = spark.createDataFrame(rows, "request_id long, directive string, root string")
    imports = quarantine.import_entries(entries(spark, AUTO))
    out = {r.request_id: r for r in governed.licensed_augmentation(df, imports, GAP_INITIALS).collect()}
    assert out[0].licensed and out[0].coverage_status == "COVERED" and not out[0].lexical_evidence_licensed
    assert [out[i].failure_detail for i in range(1, 7)] == [
        "root_directive_DEFER", "root_directive_BLOCK", "no_root_claim_for_accepted_directive",
        "root_claim_has_no_radicals_field", "domain_directive_absent", "root_directive_not_accepted:X"]
    assert predicates.licensed_only(df).count() == 1


def test_id_uniqueness_and_reviews(spark):
    imports = quarantine.import_entries(entries(spark, AUTO, dict(AUTO, entry_id="x"), REVIEW))
    cl = claims.root_claims_build(imports)
    ids = audit.all_ids(claim=(cl, "claim_id"), origin=(claims.origin_candidates(cl), "origin_id"))
    assert audit.audit_id_uniqueness(ids).count() == 0
    certs = spark.createDataFrame([("a", 1, "c1", "TEXT_VERIFIED", "HUMAN_REVIEWER"), ("a", 2, "c2", "AUDIT_PASSED", "HUMAN_AUDITOR")],
                                  "target_id string, reviewed_at long, certificate_id string, granted_state string, reviewer_type string")
    recs = spark.createDataFrame([("a", "TEXT_CANDIDATE"), ("b", "TEXT_CANDIDATE")], "rid string, review_state string")
    out = {r.rid: r.effective_state for r in audit.review_apply(recs, "rid", certs).collect()}
    assert out == {"a": "AUDIT_PASSED", "b": "TEXT_CANDIDATE"}


def lines_of(spark, **texts):
    rows = [(k, v, None, None, "", None, None) for k, v in texts.items()]
    return spark.createDataFrame(rows, LINE)


def test_body_segments_and_claims(spark):
    text = {"a": "الحلك شدة السواد وبقال أسود حالك إذا اشتد سواده .", "p": "شعر … شعر",
            "b": "قال ابن دريد : الحلكة السواد كله ومن الباب الحلكاء دويبة والأصل الآخر الغوص فى الرمل"}
    e = entries(spark, dict(AUTO, body_line_ids=["a", "p", "b"], poetry_line_ids=["p"]))
    bodies = body.resolve_body(e, lines_of(spark, **text), A.DISCOURSE)
    whole = bodies.first().body
    assert "ويقال أسود" in whole and "شعر" not in whole
    segs = body.segment_body(bodies, A.DISCOURSE).orderBy("pos").collect()
    assert [s.segment_type for s in segs] == ["CONTINUATION", "USAGE", "AUTHORITY", "BRANCH", "SECOND_ORIG"]
    assert [s.origin_index for s in segs] == [0, 0, 0, 0, 1]
    rest = "".join(whole.split())
    assert "".join("".join((s.marker + s.text).split()) for s in segs) == rest
    rows = claimgraph.extract_claims(body.segment_body(bodies, A.DISCOURSE), A.DISCOURSE)
    got = {r.claim_type: r for r in rows.collect()}
    assert got["USAGE_CONDITIONAL"].term == "أسود حالك" and got["USAGE_CONDITIONAL"].definition == "اشتد سواده"
    assert {"BRANCH_ITEM", "ORIGIN_BOUNDARY", "AUTHORITY_CITATION"} <= set(got)
    nodes = claimgraph.claim_nodes(rows, A.DISCOURSE)
    edges = claimgraph.claim_edges(nodes, A.DISCOURSE).collect()
    assert {x.edge_type for x in edges} == {"CLAIM_ABOUT", "ATTRIBUTED_TO", "SUPPORTED_BY"}
    arrays = body.segment_arrays(bodies, A.DISCOURSE)
    found = origins.origins(e, arrays.select("entry_id", "boundary_pos"), A.DISCOURSE).orderBy("origin_index").collect()
    assert [(o.semantic_nucleus, o.gloss_method) for o in found] == [("السواد", "SOURCE_EXPLICIT"), (None, "NOT_EXTRACTABLE")]


def test_short_text_resets_marker(spark):
    df = spark.createDataFrame([("e", "قيل ا قال الخليل كلام طويل")], "entry_id string, body string")
    segs = body.segment_body(df, A.DISCOURSE).collect()
    assert [(s.segment_type, s.text) for s in segs] == [("AUTHORITY", "كلام طويل")]
    assert V.REVIEW_STATES.index("AUDIT_PASSED") == 15
