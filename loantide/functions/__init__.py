from . import buckets, dates, numbers, rules, text

__all__ = ["buckets", "dates", "numbers", "rules", "text"]
