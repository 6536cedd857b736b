"""Frame operators: staging, rules, linkage, candidates, owners, discovery, quality and relational recipes."""
