"""Explicit read schemas: nothing is inferred from data."""

# One row per paper.
PAPERS = """
    arxiv_id string, title string, abstract string, categories array<string>,
    authors array<struct<name: string>>, submitted_at timestamp, updated_at_api timestamp,
    ss_paper_id string, citation_count int, max_h_index int, total_prior_papers int,
    has_code boolean, hf_paper_id string, hf_upvotes int, hf_github_repo string,
    github_stars_t60 int, hype_label boolean, ingested_at timestamp, enriched_at timestamp
"""

METADATA_DUMP = """
    id string, title string, abstract string, categories string, update_date string,
    versions array<struct<created: string>>, authors_parsed array<array<string>>
"""

CODE_LINKS = "paper_arxiv_id string, repo_url string, is_official boolean"

FEED_ENTRY = """
    id string, title string, summary string, published string, updated string,
    author array<struct<name: string>>, category array<struct<_term: string>>
"""

PAPER_BATCH = """
    ids array<string>,
    response array<struct<paperId: string, citationCount: int,
                          authors: array<struct<authorId: string>>>>
"""

AUTHOR_BATCH = "ids array<string>, response array<struct<hIndex: int, paperCount: int>>"

DAILY_ENTRY = "paper struct<id: string, upvotes: int, githubRepo: string>"

PAPER_LOOKUP = """
    arxiv_id string, status int, body struct<id: string, upvotes: int, githubRepo: string>
"""

REPO_LOOKUP = "arxiv_id string, repo_url string, status int, body struct<stargazers_count: int>"

TREE_MODEL = """
    learner struct<
        learner_model_param: struct<base_score: string>,
        gradient_booster: struct<model: struct<trees: array<struct<
            left_children: array<int>, right_children: array<int>, split_indices: array<int>,
            split_conditions: array<float>, base_weights: array<float>>>>>>
"""

MODEL_META = """
    model_name string, alias string, version string, run_id string, feature_cols array<string>,
    num_features int, threshold double, feature_version string
"""

METRICS = "name string, labels map<string, string>, value double, ts timestamp"

RUN_LOG = "run_id string, kind string, key string, value string"
