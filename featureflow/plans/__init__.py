"""Training, tuning and scoring jobs put together from the operators."""
