"""Multi-step jobs: cleaning pipeline, model training, tuning, explanation, rules and the run ledger."""
