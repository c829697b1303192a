"""Canonical schemas of chunks, messages, metadata buckets and graphs."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string


def _schema(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


CHUNK_DDL = """
id STRING, kb_id STRING, doc_id STRING, docnm_kwd STRING, mom_id STRING, img_id STRING, doc_type_kwd STRING, title_tks STRING,
title_sm_tks STRING, content_with_weight STRING, content_ltks STRING, content_sm_ltks STRING, important_kwd ARRAY<STRING>,
important_tks STRING, question_kwd ARRAY<STRING>, question_tks STRING, tag_kwd ARRAY<STRING>, tag_feas MAP<STRING,DOUBLE>,
pagerank_fea DOUBLE, available_int INT, chunk_order_int INT, page_num_int ARRAY<INT>, top_int ARRAY<INT>,
position_int ARRAY<ARRAY<INT>>, create_timestamp_flt DOUBLE, knowledge_graph_kwd STRING, entity_kwd STRING, entity_type_kwd STRING,
from_entity_kwd STRING, to_entity_kwd STRING, entities_kwd ARRAY<STRING>, weight_int INT, weight_flt DOUBLE, rank_flt DOUBLE,
n_hop_with_weight STRING, source_id ARRAY<STRING>, removed_kwd STRING, raptor_kwd STRING, raptor_layer_int INT, extra STRING,
chunk_data MAP<STRING,STRING>, vec ARRAY<FLOAT>
"""
MESSAGE_DDL = """
id STRING, message_id STRING, message_type_kwd STRING, source_id STRING, memory_id STRING, user_id STRING, agent_id STRING,
session_id STRING, zone_id INT, valid_at STRING, invalid_at STRING, forget_at STRING, status_int INT, content_ltks STRING,
tokenized_content_ltks STRING, vec ARRAY<FLOAT>
"""
BUCKET_DDL = "key STRING, value STRING, doc_id STRING"
VERTEX_DDL = "id STRING, description STRING, source_id ARRAY<STRING>, entity_type STRING, rank INT, pagerank DOUBLE"
EDGE_DDL = "src STRING, dst STRING, weight DOUBLE, description STRING, keywords ARRAY<STRING>, source_id ARRAY<STRING>"
DOCUMENT_DDL = "id STRING, source STRING, name STRING, extension STRING, blob BINARY, size BIGINT, updated_at TIMESTAMP, fingerprint STRING, metadata MAP<STRING,STRING>"

#: Column name suffix -> Spark type.
SUFFIX_TYPES = {
    "_kwd": "array<string>", "_tks": "string", "_ltks": "string", "_sm_tks": "string", "_sm_ltks": "string", "_int": "int", "_long": "bigint",
    "_flt": "double", "_dt": "timestamp", "_fea": "double", "_feas": "map<string,double>", "_vec": "array<float>",
}
#: Keyword columns that hold one value.
SCALAR_KEYWORDS = {"docnm_kwd", "knowledge_graph_kwd", "important_kwd", "question_kwd"}


def chunk_schema() -> StructType:
    return _schema(CHUNK_DDL)


def message_schema() -> StructType:
    return _schema(MESSAGE_DDL)


def document_schema() -> StructType:
    return _schema(DOCUMENT_DDL)


def type_of(column: str) -> str:
    """The type that a column name's suffix stands for."""
    for suffix in sorted(SUFFIX_TYPES, key=len, reverse=True):
        if column.endswith(suffix):
            return "string" if suffix == "_kwd" and column in SCALAR_KEYWORDS else SUFFIX_TYPES[suffix]
    return "string"
