"""DataFrame in, DataFrame out: silver, gold, rules, quality, features, documents."""
