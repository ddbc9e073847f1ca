"""gradeloom: Spark jobs that prepare instruction-tuning tables, render chat
prompts, extract structured answers from model responses, and score models."""
