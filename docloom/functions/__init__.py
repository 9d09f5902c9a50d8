"""docloom.functions"""
