"""curatrix.sources"""
