"""curatrix.streaming"""
