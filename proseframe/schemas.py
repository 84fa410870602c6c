"""Declared row types. Nothing in the package infers a schema from data."""

SAMPLE = "sample_id bigint, text string, label string"
QUARANTINE = "source_file string, raw string, reason string"
PROMPT = "prompt_id bigint, prompt string"
# after the prompt's id, of whatever type it is
COMPLETION = "provider string, output string, attempts int, error string"
METRIC_LOG = (
    "run_id string, log_seq bigint, epoch double, step bigint, train_loss double, "
    "eval_loss double, eval_perplexity double, learning_rate double, "
    "epoch_time double, total_time double"
)
METRIC_VALUE = "model string, metric string, value double"

# Split names, in the order used when the wanted split is missing.
SPLITS = ("train", "validation", "test")
