"""tessera: batch analytics operators on Spark DataFrames.

Term ranking over article text, forum question/answer scoring with exact
integer k-means, and time-use survey summaries.  Every operator takes
DataFrames and returns a DataFrame; the caller owns the SparkSession and
runs the actions.  The public operators are re-exported here.
"""

from tessera.functions.survey import age_band, balanced_sum, group_hours, sex_label, working_status
from tessera.functions.text import matched_terms, mentions_term
from tessera.functions.vectors import nearest_center, nearest_distance, point_distance
from tessera.operators.clusters import cluster_report, cluster_results
from tessera.operators.columns import column_max, column_sum
from tessera.operators.forum import (
    answer_high_score,
    answers,
    first_tag_index,
    grouped_postings,
    nested_postings,
    posting_vectors,
    question_answer_pairs,
    questions,
    scored_postings,
)
from tessera.operators.kmeans import (
    average_vectors,
    centroid_shift,
    converged,
    kmeans,
    kmeans_step,
    weighted_vectors,
)
from tessera.operators.posting_store import PostingStore, open_index, write_index
from tessera.operators.sampling import (
    SketchStore,
    group_sketch,
    merge_sketches,
    sample_fixed,
    sample_per_group,
    sample_vectors,
    sketch_sample,
)
from tessera.operators.survey import (
    classify_columns,
    time_usage_grouped,
    time_usage_grouped_sql,
    time_usage_grouped_typed,
    time_usage_summary,
    time_usage_summary_arrays,
    time_usage_summary_typed,
)
from tessera.operators.terms import (
    inverted_index,
    rank_terms_count,
    rank_terms_index,
    rank_terms_scan,
    term_doc_count,
    term_hits,
)
from tessera.plans.pipelines import pipeline_clusters, pipeline_survey, pipeline_survey_arrays, pipeline_terms
from tessera.session import materialize, release
from tessera.sources.articles import parse_articles, read_articles
from tessera.sources.lines import read_lines
from tessera.sources.postings import parse_postings, read_postings
from tessera.sources.survey import read_survey, read_survey_arrays, survey_arrays, survey_row, survey_schema

__version__ = "0.1.0"

__all__ = [
    "PostingStore", "SketchStore", "age_band", "answer_high_score", "answers", "average_vectors", "balanced_sum",
    "centroid_shift", "classify_columns", "cluster_report", "cluster_results", "column_max",
    "column_sum", "converged", "first_tag_index", "group_hours", "group_sketch",
    "grouped_postings", "inverted_index", "kmeans", "kmeans_step", "matched_terms", "materialize", "mentions_term",
    "merge_sketches", "nearest_center", "nearest_distance", "nested_postings", "open_index", "parse_articles", "parse_postings", "pipeline_clusters",
    "pipeline_survey", "pipeline_survey_arrays", "pipeline_terms", "point_distance", "posting_vectors",
    "question_answer_pairs", "questions", "rank_terms_count", "rank_terms_index",
    "rank_terms_scan", "read_articles", "read_lines", "read_postings", "read_survey",
    "read_survey_arrays", "release",
    "sample_fixed", "sample_per_group", "sample_vectors", "scored_postings", "sex_label", "sketch_sample",
    "survey_arrays", "survey_row", "survey_schema", "term_doc_count", "term_hits", "time_usage_grouped",
    "time_usage_grouped_sql", "time_usage_grouped_typed", "time_usage_summary",
    "time_usage_summary_arrays", "time_usage_summary_typed", "weighted_vectors", "working_status", "write_index",
]
