"""Declared table schemas.

Fixed values: column names, types and nesting follow the published layouts of the two
corpora; parts that several tables share are written once. UUIDs are kept as strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

_NAMED = "STRUCT<id: STRING, display_name: STRING>"
_HIERARCHY = f"subfield: {_NAMED}, field: {_NAMED}, domain: {_NAMED}"
_MONEY = "STRUCT<value: DOUBLE, currency: STRING, provenance: STRING, value_usd: DOUBLE>"
_PLACE = "STRUCT<id: STRING, display_name: STRING, landing_page_url: STRING, pdf_url: STRING>"
_CITEDNESS = "STRUCT<`2yr_mean_citedness`: DOUBLE, h_index: INT, i10_index: INT>"
_INSTITUTION = "id: STRING, display_name: STRING, country_code: STRING, ror: STRING"

# Types of the columns that enrichment adds to papers.
TOPIC = f"STRUCT<id: STRING, display_name: STRING, {_HIERARCHY}, score: DOUBLE>"
TOPICS = f"ARRAY<{TOPIC}>"
CONCEPTS = (
    "ARRAY<STRUCT<id: STRING, wikidata: STRING, display_name: STRING, level: BIGINT, score: DOUBLE>>"
)

WORKS = f"""
    id STRING, doi STRING, title STRING, display_name STRING,
    publication_year INT, publication_date DATE, created_date TIMESTAMP, updated_date TIMESTAMP,
    language STRING, type STRING, type_crossref STRING,
    is_retracted BOOLEAN, is_paratext BOOLEAN, has_fulltext BOOLEAN, fulltext_origin STRING,
    license STRING, fwci DOUBLE, cited_by_count INT,
    countries_distinct_count INT, institutions_distinct_count INT, locations_count INT,
    corresponding_author_ids ARRAY<STRING>, corresponding_institution_ids ARRAY<STRING>,
    referenced_works ARRAY<STRING>, related_works ARRAY<STRING>,
    biblio STRUCT<volume: STRING, issue: STRING, first_page: STRING, last_page: STRING>,
    apc_list {_MONEY}, apc_paid {_MONEY},
    citation_normalized_percentile
        STRUCT<value: DOUBLE, is_in_top_1_percent: BOOLEAN, is_in_top_10_percent: BOOLEAN>,
    counts_by_year ARRAY<STRUCT<year: INT, cited_by_count: INT>>,
    authorships ARRAY<STRUCT<
        author_position: STRING,
        author: STRUCT<id: STRING, display_name: STRING, orcid: STRING>,
        institutions: ARRAY<STRUCT<{_INSTITUTION}>>,
        is_corresponding: BOOLEAN>>,
    concepts ARRAY<STRUCT<
        id: STRING, wikidata: STRING, display_name: STRING, level: INT, score: DOUBLE>>,
    topics ARRAY<STRUCT<id: STRING, display_name: STRING, {_HIERARCHY}>>,
    keywords ARRAY<STRUCT<keyword: STRING, score: DOUBLE>>,
    mesh ARRAY<STRUCT<
        descriptor_ui: STRING, descriptor_name: STRING,
        qualifier_ui: STRING, qualifier_name: STRING, is_major_topic: BOOLEAN>>,
    grants ARRAY<STRUCT<funder: STRING, funder_display_name: STRING, award_id: STRING>>,
    sustainable_development_goals
        ARRAY<STRUCT<id: STRING, display_name: STRING, score: DOUBLE>>,
    locations ARRAY<STRUCT<
        is_oa: BOOLEAN, landing_page_url: STRING, pdf_url: STRING,
        source: STRUCT<
            id: STRING, display_name: STRING, issn_l: STRING, is_oa: BOOLEAN, type: STRING>>>,
    primary_location {_PLACE}, best_oa_location {_PLACE},
    open_access STRUCT<is_oa: BOOLEAN, oa_status: STRING, oa_url: STRING>,
    abstract_inverted_index STRING
"""

SOURCES = f"""
    id STRING, display_name STRING, abbreviated_title STRING, apc_usd INT, cited_by_count INT,
    country_code STRING, created_date TIMESTAMP, updated_date TIMESTAMP, homepage_url STRING,
    host_organization STRING, host_organization_name STRING,
    is_core BOOLEAN, is_in_doaj BOOLEAN, is_oa BOOLEAN, issn_l STRING, type STRING,
    works_api_url STRING, works_count INT,
    alternate_titles ARRAY<STRING>, host_organization_lineage ARRAY<STRING>, issn ARRAY<STRING>,
    apc_prices ARRAY<STRUCT<price: INT, currency: STRING>>,
    counts_by_year ARRAY<STRUCT<year: INT, works_count: INT, cited_by_count: INT>>,
    ids STRUCT<fatcat: STRING, issn: ARRAY<STRING>, issn_l: STRING, mag: BIGINT,
               openalex: STRING, wikidata: STRING>,
    societies ARRAY<STRUCT<url: STRING, organization: STRING>>,
    summary_stats {_CITEDNESS},
    x_concepts ARRAY<STRUCT<
        id: STRING, wikidata: STRING, display_name: STRING, level: INT, score: DOUBLE>>
"""

AUTHORS = f"""
    id STRING, orcid STRING, display_name STRING, works_count INT, cited_by_count INT,
    created_date TIMESTAMP, updated_date TIMESTAMP, works_api_url STRING,
    display_name_alternatives ARRAY<STRING>,
    summary_stats {_CITEDNESS},
    ids STRUCT<openalex: STRING, orcid: STRING>,
    affiliations ARRAY<STRUCT<
        institution: STRUCT<{_INSTITUTION}, type: STRING>, years: ARRAY<INT>>>,
    last_known_institutions ARRAY<STRUCT<{_INSTITUTION}, type: STRING>>,
    topics ARRAY<STRUCT<
        id: STRING, display_name: STRING, count: INT, score: DOUBLE, {_HIERARCHY}>>,
    topic_share ARRAY<STRUCT<id: STRING, display_name: STRING, value: DOUBLE, {_HIERARCHY}>>,
    x_concepts ARRAY<STRUCT<
        id: BIGINT, wikidata: STRING, display_name: STRING, level: INT, score: DOUBLE, count: INT>>,
    counts_by_year ARRAY<STRUCT<
        year: INT, works_count: INT, oa_works_count: INT, cited_by_count: INT>>
"""

PAPERS = """
    corpusid BIGINT,
    externalids STRUCT<MAG: STRING, CorpusId: STRING, ACL: STRING, PubMed: STRING, DOI: STRING,
                       PubMedCentral: STRING, DBLP: STRING, ArXiv: STRING>,
    url STRING, title STRING, authors ARRAY<STRUCT<authorId: STRING, name: STRING>>,
    venue STRING, publicationvenueid STRING, year BIGINT,
    referencecount BIGINT, citationcount BIGINT, influentialcitationcount BIGINT,
    isopenaccess BOOLEAN,
    s2fieldsofstudy ARRAY<STRUCT<category: STRING, source: STRING>>,
    publicationtypes ARRAY<STRING>, publicationdate DATE,
    journal STRUCT<name: STRING, pages: STRING, volume: STRING>
"""

RUN_LOG = """
    run_id BIGINT, recorded_at TIMESTAMP, job STRING, mode STRING, source STRING, path STRING,
    total_rows BIGINT, rows_updated BIGINT, rows_covered BIGINT, distinct_years BIGINT, min_year BIGINT, max_year BIGINT,
    elapsed_seconds DOUBLE
"""

TABLES = {"works": WORKS, "sources": SOURCES, "authors": AUTHORS, "papers": PAPERS}


def struct_of(ddl: str) -> T.StructType:
    """Parse a column list into a `StructType`."""
    return T.StructType.fromDDL(ddl)


def type_of(ddl: str) -> T.DataType:
    """Parse the text of one data type."""
    return T.DataType.fromDDL(ddl)
