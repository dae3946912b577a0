"""DataFrame operators grouped by concern (clean, features, validate, profile, drift, sampling,
metrics, ml, history); each takes DataFrames plus column names and returns a DataFrame."""
