"""Column expressions: hash uniforms, Poisson weights, score buckets, normal tail."""
