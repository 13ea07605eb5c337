"""Table operators: rules, history, profiling, reports, selection, sampling."""
