"""Table operators: split, corpus statistics, tokenizer, batches, metrics, scoring, paths."""
